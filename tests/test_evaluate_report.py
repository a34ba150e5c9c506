import json
import os
import pathlib
import random

import pytest

from sf_paths import SF001

from cmdeval.operators import evaluate, report
from cmdeval.session import scratch_path


@pytest.fixture(scope="module")
def small(spark):
    suite = spark.createDataFrame([("s1", 1, "q1", "ls -la"), ("s1", 2, "q2", "pwd"), ("s2", 1, "q3", "df -h")],
                                  "suite string, id long, nl string, gold string")
    resp = spark.createDataFrame([("base", "s1", 1, "```bash\nls -la\n```", 2.0),
                                  ("tuned", "s1", 1, " ls -la\n", 1.0),
                                  ("tuned", "s1", 2, "pwd", 3.0),
                                  ("base", "s2", 1, "df", 4.0),
                                  ("tuned", "s2", 1, "df -h", 0.5)],
                                 "model string, suite string, id long, raw_prediction string, latency double")
    return suite, resp


def test_missing_answers_become_blank(spark, small):
    res = evaluate.score(*small, ["base", "tuned"])
    rows = {(r.model, r.suite, r.id): r for r in res.collect()}
    assert len(rows) == 6
    miss = rows[("base", "s1", 2)]
    assert (miss.raw_prediction, miss.latency, miss.is_error, miss.em, miss.f1, miss.bleu4) == ("", 0.0, True, 0.0, 0.0, 0.0)
    assert rows[("tuned", "s1", 1)].raw_prediction == "ls -la"
    summ = {(r.model, r.suite): r for r in evaluate.summarise(res).collect()}
    b = summ[("base", "s1")]
    assert (b.num_samples, b.exact_match_pct, b.single_line_clean_pct, b.avg_latency_sec, b.n_errors,
            b.avg_latency_ok) == (2, 50.0, 50.0, 1.0, 1, 2.0)
    t = summ[("tuned", "s1")]
    assert (t.exact_match_pct, t.mean_token_f1, t.avg_latency_sec) == (100.0, 100.0, 2.0)


def test_compare_and_markdown(spark, small):
    summ = evaluate.summarise(evaluate.score(*small, ["base", "tuned"]))
    cmp = {(r.suite, r.metric): r for r in report.compare(summ, "base", "tuned").collect()}
    lat = cmp[("s1", "avg_latency_sec")]
    assert (lat.base, lat.tuned, lat.delta) == (1.0, 2.0, -100.0)
    em = cmp[("s1", "exact_match_pct")]
    assert em.delta == pytest.approx(50.0)
    lines = sorted((r.suite, r.line_no, r.line) for r in report.markdown(report.compare(summ, "base", "tuned")).collect())
    s1 = [l for s, _, l in lines if s == "s1"]
    assert s1[0] == "### s1" and s1[2] == "| :--- | :--- | :--- | :--- |"
    assert "| **Exact Match (EM %)** | 50.0% | **100.0%** | +50.0% |" in s1
    assert "| **Mean Latency (sec)** | 1.0s | **2.0s** | ⚡ -100.0% faster |" in s1


def test_zero_base_latency_gives_null(spark):
    summ = spark.createDataFrame([("base", "s", 0.0), ("tuned", "s", 1.0)],
                                 "model string, suite string, avg_latency_sec double")
    assert report.compare(summ, "base", "tuned").collect()[0].delta is None


def test_json_report_round_trip(spark, small):
    path = scratch_path(spark, "test-json")
    res = evaluate.score(*small, ["base", "tuned"])
    out = report.write_json(res, path)
    s, r = report.read_json_report(spark, path)
    assert r.count() == 6 and s.count() == 4
    detail_files = [f for root, _, fs in os.walk(out["results"].replace("file:", "")) for f in fs if f.endswith(".json")]
    assert detail_files
    recs = [json.loads(l) for f in detail_files for l in open(os.path.join(
        [root for root, _, fs in os.walk(out["results"].replace("file:", "")) if f in fs][0], f))]
    assert {"id", "nl", "gold", "raw_prediction", "clean_prediction", "em", "f1", "bleu4", "latency"} <= set(recs[0])


def test_summary_has_the_same_bits_however_dealt(spark):
    rows = [("m", "s", i, 1.0 if i % 7 else 0.0, 1 / (i % 13 + 1), 1 / (i % 11 + 3), 0.1 * (i % 17), i % 5 == 0, 1, i % 90) for i in range(2000)]
    df = spark.createDataFrame(rows, "model string, suite string, id long, em double, f1 double, bleu4 double, latency double, "
                                     "is_error boolean, single_line int, output_chars long")
    assert len({tuple(evaluate.summarise(df.repartition(n, "id")).collect()[0]) for n in (1, 7, 200)}) == 1
    failed = evaluate.summarise(df.where("is_error")).collect()[0]
    assert failed.avg_latency_ok is None and failed.n_errors == failed.num_samples


def test_report_is_published_whole_or_not_at_all(spark, small, monkeypatch):
    path = scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        report.read_json_report(spark, path)
    res = evaluate.score(*small, ["base", "tuned"])
    report.write_json(res.where("suite = 's1'"), path, {"base": "Base (0.5B)"})
    assert {(r.model, r.label) for r in report.read_models(spark, path).collect()} == {("base", "Base (0.5B)"), ("tuned", "tuned")}

    def killed(_):
        raise KeyboardInterrupt
    with monkeypatch.context() as m:  # details are written, then the run is killed
        m.setattr(report, "summarise", killed)
        with pytest.raises(KeyboardInterrupt):
            report.write_json(res, path)
    s, r = report.read_json_report(spark, path)
    assert s.count() == 2 and r.count() == 4
    report.write_json(res, path)
    s, r = report.read_json_report(spark, path)
    assert s.count() == 4 and r.count() == 6 and report.read_models(spark, path).where("label = model").count() == 2


def test_report_in_compressed_slices_holds_the_same_records(spark, small):
    suite, resp = small
    nowhere = spark.createDataFrame([("s1", None, "q4", "ls"), ("s1", None, "q5", None)], suite.schema)
    res = evaluate.score(suite.unionByName(suite).unionByName(nowhere), resp, ["base", "tuned"])
    plain, dealt = scratch_path(spark, "plain"), scratch_path(spark, "dealt")
    report.write_json(res, plain)
    out = report.write_json(res, dealt, compression="gzip", slices=3)
    names = [f for _, _, fs in os.walk(out["results"].replace("file:", "")) for f in fs if f.startswith("part-")]
    assert names and all(f.endswith(".json.gz") for f in names)
    for was, now in zip(report.read_json_report(spark, plain), report.read_json_report(spark, dealt)):
        assert sorted(map(repr, was.collect())) == sorted(map(repr, now.collect()))
    assert report.read_json_report(spark, dealt)[1].count() == 16


def shuffle_files(spark):
    """Bytes of each of the session's shuffle files."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p.name: p.stat().st_size for d in dirs for p in pathlib.Path(d.getPath()).rglob("shuffle_*.data")}


@pytest.mark.parametrize("query", ["json_summary", "json_report", "json_models"])
def test_report_takes_less_disk_than_its_texts(spark, tmp_path, query):
    from cmdeval.plans import QUERIES, catalog
    rnd = random.Random(3)
    rows = [(i, " ".join(f"{rnd.randrange(10 ** 6)}" for _ in range(500))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    before = shuffle_files(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert QUERIES[query](spark, str(tmp_path)).count() == {"json_summary": 4, "json_report": 400, "json_models": 2}[query]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    folder = catalog._written_report(spark, str(tmp_path)).replace("file:", "")
    held = sum(os.path.getsize(os.path.join(root, f)) for root, _, fs in os.walk(folder) for f in fs)
    texts = sum(len(t) for _, t in rows)
    assert held < 2 * texts  # of each model there is a text and three like it
    assert sum(n for f, n in shuffle_files(spark).items() if f not in before) < texts / 10  # no texts among them


def test_fixture_counts_calls_as_the_log_has_them(spark):
    """Missing and failed calls are errors; a failed call before an answer is not."""
    from cmdeval.plans import QUERIES
    ids = [r.doc_id for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").collect()]
    for row in QUERIES["suite_summary"](spark, SF001).collect():
        own = [i for i in ids if (i % 2 == 0) == (row.suite == "suite_a")]
        assert row.num_samples == len(own)
        assert row.n_errors == sum(i % 11 == 0 or i % 17 == 0 for i in own)


def test_write_markdown_file_order(spark, small):
    summ = evaluate.summarise(evaluate.score(*small, ["base", "tuned"]))
    lines_df = report.markdown(report.compare(summ, "base", "tuned"))
    path = scratch_path(spark, "md")
    report.write_markdown(lines_df, path)
    local = path[len("file:"):] if path.startswith("file:") else path
    parts = sorted(f for f in os.listdir(local) if f.startswith("part-"))
    text = "".join(open(os.path.join(local, f)).read() for f in parts).splitlines()
    assert text[0] == "### s1" and text[2] == "| :--- | :--- | :--- | :--- |"
    assert text.index("### s2") > text.index("| **Mean Latency (sec)** | 1.0s | **2.0s** | ⚡ -100.0% faster |")
    assert len(text) == lines_df.count()
