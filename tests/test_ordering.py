"""Places in a global order and numbers inside a suite."""

import json
import os
import random

import pyarrow as pa
import pytest

from cmdeval.config import TrainConfig
from cmdeval.operators import evaluate, ordering, prep
from cmdeval.session import scratch_path
from cmdeval.sources import read_suite

from test_evaluate_report import shuffle_files


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranked_over_many_ranges(spark, many_ranges):
    from pyspark.sql import functions as F
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit("kept").alias("rank"), F.lit(1).alias("other"))
    rows = ordering.ranked(df, [F.col("v")], "place").collect()
    assert sorted((r.place, r.v, r.rank) for r in rows) == [(i + 1, i, "kept") for i in range(1000)]
    assert ordering.ranked(df.where("v < 0"), [F.col("v")], "place").count() == 0
    ties = ordering.ranked(df.withColumn("v", F.lit(1)), [F.col("v")], "rank").collect()
    assert sorted(r.rank for r in ties) == list(range(1, 1001))


def test_full_order_continues_the_capped_plan(spark, many_ranges):
    pairs = spark.range(500).selectExpr("id AS pair_id", "'x' AS command")
    full = {r.pair_id: (r.rank, r.step) for r in prep.training_plan(pairs, max_steps=None).collect()}
    assert sorted(r for r, _ in full.values()) == list(range(1, 501))
    capped = prep.training_plan(pairs, max_steps=5).collect()
    assert len(capped) == 80 and all(full[r.pair_id] == (r.rank, r.step) for r in capped)
    rest = prep.training_plan(pairs, config=TrainConfig(max_steps=None), resume_step=5).collect()
    assert {r.pair_id: (r.rank, r.step) for r in rest} == {k: v for k, v in full.items() if v[1] > 5} and len(rest) == 420
    with pytest.raises(ValueError):
        prep.training_plan(pairs, resume_step=-1)


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_positions_follow_the_lines_of_several_files(spark, fmt, monkeypatch):
    path = scratch_path(spark, f"numbered-{fmt}")
    rows = [("a" if i % 3 else "b", f"q{i}", f"line\nbreak {i}") for i in range(700)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, suite string, nl string, gold string")
    writer = df.repartitionByRange(4, "i").sortWithinPartitions("i").drop("i").write
    getattr(writer.option("header", True).option("escape", '"') if fmt == "csv" else writer, fmt)(path)
    monkeypatch.setattr("cmdeval.sources.readers.NUMBER_ROWS", 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # files are cut, where they can be
    try:
        got = read_suite(spark, path, fmt, positions=True).collect()
        named = read_suite(spark, path, fmt, name="all", positions=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want, n = {}, {"a": 0, "b": 0}
    for suite, nl, _ in rows:
        n[suite] += 1
        want[nl] = (suite, n[suite])
    assert {r.nl: (r.suite, r.id) for r in got} == want
    assert {r.nl: (r.suite, r.id) for r in named} == {nl: ("all", i + 1) for i, (_, nl, _) in enumerate(rows)}


def test_results_of_a_suite_without_ids(spark):
    path = scratch_path(spark, "no-ids")
    spark.createDataFrame([("q1", "ls"), ("q2", "pwd")], "nl string, gold string").coalesce(1).write.json(path)
    suite = read_suite(spark, path, "json", name="s", positions=True)
    calls = spark.createDataFrame([("m", "s", 2, "pwd", 1.0)], "model string, suite string, id long, raw_prediction string, latency double")
    got = {r.id: (r.gold, r.em, r.is_error) for r in evaluate.sample_results(evaluate.score(suite, calls, ["m"])).collect()}
    assert got == {1: ("ls", 0.0, True), 2: ("pwd", 1.0, False)}
    assert json.loads(suite.where("id = 1").toJSON().first())["nl"] == "q1"


def test_counts_run_on_over_batches():
    rows = [("a", 1), (None, 1), ("a", 1), ("a", 2), (None, None), (None, 1), ("a", 1), ("", 2), ("a", 2), (None, None)]
    batches = [tuple(pa.array([r[i] for r in rows[a:b]], t) for i, t in enumerate((pa.string(), pa.int64())))
               for a, b in ((0, 3), (3, 3), (3, 4), (4, 10))]
    got = [x for out in ordering.running_counts(iter(batches)) for x in out.to_pylist()]
    assert got == [rows[:i + 1].count(r) for i, r in enumerate(rows)]


def documents(spark, folder):
    rnd = random.Random(3)
    rows = [(i, "\n".join(f"{rnd.randrange(10 ** 6)}" for _ in range(500))) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    return rows


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_positions_take_no_text_across_the_network(spark, tmp_path, fmt):
    texts = sum(len(t) for _, t in documents(spark, tmp_path))
    path = scratch_path(spark, "no-texts")
    writer = spark.read.parquet(f"{tmp_path}/documents.parquet").selectExpr("'s' AS suite", "text AS nl", "text AS gold").write
    getattr(writer.option("header", True).option("escape", '"'), fmt)(path)
    before = shuffle_files(spark)
    assert sorted(r.id for r in read_suite(spark, path, fmt, positions=True).collect()) == list(range(1, 201))
    assert sum(n for f, n in shuffle_files(spark).items() if f not in before) < texts / 10


def test_suite_files_of_positional_results_are_compressed(spark, tmp_path, monkeypatch):
    from cmdeval.plans import QUERIES, catalog
    rows, paths = documents(spark, tmp_path), []
    monkeypatch.setattr(catalog, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
    got = QUERIES["positional_results"](spark, str(tmp_path)).collect()
    want = {(m, f"suite_{'ab'[i % 2]}", i // 2 + 1, t) for i, t in rows for m in ("base", "tuned")}
    assert {(r.model, r.suite, r.id, r.nl) for r in got} == want and len(got) == 400
    folder = paths[0].replace("file:", "")
    assert sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder)) < 1.5 * sum(len(t) for _, t in rows)  # twice and more as plain JSON
