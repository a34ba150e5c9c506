import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from cmdeval.operators import telemetry
from cmdeval.plans import catalog
from cmdeval.session import scratch_path
from cmdeval.sources import fixtures
from cmdeval import streaming
from sf_paths import SF001


def _log(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("r1", s, t0 + dt.timedelta(seconds=10 * s), 4.0 - s * 0.1) for s in range(1, 41)]
    rows += [("r2", 1, t0, 2.0), ("r2", 2, t0 + dt.timedelta(seconds=5), 1.5)]
    return spark.createDataFrame(rows, "run_id string, step long, ts timestamp, loss double")


def test_convergence(spark):
    got = {r.run_id: r for r in telemetry.convergence(_log(spark)).collect()}
    r1 = got["r1"]
    assert (r1.n_logged, r1.first_step, r1.last_step) == (40, 1, 40)
    assert abs(r1.first_loss - 3.9) < 1e-12 and abs(r1.final_loss - 0.0) < 1e-9
    assert r1.runtime_sec == 390.0
    assert got["r2"].loss_drop == 0.5


def test_tail_keeps_last_n_per_run(spark):
    out = telemetry.tail(_log(spark), n=30).collect()
    steps = sorted(r.step for r in out if r.run_id == "r1")
    assert steps == list(range(11, 41))
    assert sorted(r.step for r in out if r.run_id == "r2") == [1, 2]


def test_peak_memory(spark):
    gib = 1 << 30
    df = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), "Initial State", gib // 2, 16 * gib),
                                ("a", dt.datetime(2024, 1, 1, 0, 1), "After LoRA Attached", 3 * gib // 2, 16 * gib)],
                               "run_id string, ts timestamp, label string, reserved_bytes long, total_bytes long")
    r = telemetry.peak_memory(df).collect()[0]
    assert (r.used_gib, r.total_gib, r.used_pct, r.n_samples) == (1.5, 16.0, 9.38, 2)


def test_stream_tail_equals_batch(spark):
    got = catalog.q_stream_log_tail(spark, SF001)
    batch = fixtures.run_log_from_events(catalog.table(spark, SF001, "events"))
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_stream_eval_equals_batch_and_dedupes(spark):
    suite = catalog._suite(spark, SF001)
    sim = fixtures.with_arrival_time(catalog._sim(spark, SF001))
    src = scratch_path(spark, "test-answers")
    # every answer twice: a replay must count once
    sim.unionByName(sim).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out = scratch_path(spark, "test-running")
    streaming.run_availablenow(streaming.running_evaluation(stream, suite), out, out + "-ck", mode="complete")
    got = {(r.model, r.suite): r for r in streaming.finish_running(spark.read.parquet(out)).collect()}
    from cmdeval.operators import evaluate
    res = evaluate.score(suite, catalog._sim(spark, SF001), ["base", "tuned"]).where(~F.col("is_error"))
    want = {(r.model, r.suite): r for r in evaluate.summarise(res).collect()}
    assert got.keys() == want.keys()
    for k in want:
        for c in ("num_samples", "exact_match_pct", "mean_token_f1", "mean_bleu4", "single_line_clean_pct",
                  "avg_latency_sec", "avg_output_chars"):
            assert getattr(got[k], c) == getattr(want[k], c), (k, c)


def test_stream_eval_counts_all_files_in_any_order(spark, tmp_path, monkeypatch):
    """Micro-batches of descending ids, hours apart: nothing counts as late."""
    docs = catalog.table(spark, SF001, "documents").where("doc_id < 200")
    d = tmp_path / "in"
    (d / "documents.parquet").mkdir(parents=True)
    for k, lo in enumerate((40_000, 20_000, 0)):
        spark_out = str(tmp_path / f"part{k}")
        docs.withColumn("doc_id", F.col("doc_id") + lo).coalesce(1).write.parquet(spark_out)
        made = next(x for x in os.listdir(spark_out) if x.endswith(".parquet"))
        file = d / "documents.parquet" / f"{k}.parquet"
        shutil.copy(f"{spark_out}/{made}", file)
        os.utime(file, (1_700_000_000 + 60 * k,) * 2)  # the source reads the oldest file first
    monkeypatch.setattr(catalog, "FILES_PER_BATCH", 1)
    got = {(r.model, r.suite): r.asDict() for r in catalog.q_stream_eval(spark, str(d)).collect()}
    from cmdeval.operators import evaluate
    res = evaluate.score(catalog._suite(spark, str(d)), catalog._sim(spark, str(d)), ["base", "tuned"])
    want = {(r.model, r.suite): r for r in evaluate.summarise(res.where(~F.col("is_error"))).collect()}
    assert got.keys() == want.keys() and len(want) == 4
    for k, r in got.items():
        assert r == {c: want[k][c] for c in r}, k


def test_telemetry_windows_drop_late_rows(spark):
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    first = [("r", t0 + dt.timedelta(minutes=m), "x", m, 10) for m in (1, 2, 70, 130, 200)]
    late = [("r", t0 + dt.timedelta(minutes=5), "x", 999, 10)]  # far behind the watermark
    schema = "run_id string, ts timestamp, label string, reserved_bytes long, total_bytes long"
    src = scratch_path(spark, "test-gpu")
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(src + "/a")
    stream = (spark.readStream.schema(spark.createDataFrame(first, schema).schema)
              .option("maxFilesPerTrigger", 1).parquet(src + "/*"))
    out = scratch_path(spark, "test-gpu-out")
    q = streaming.telemetry_windows(stream, "1 hour", "10 minutes")
    streaming.run_availablenow(q, out, out + "-ck")
    spark.createDataFrame(late, schema).coalesce(1).write.parquet(src + "/b")
    streaming.run_availablenow(q, out, out + "-ck")
    rows = sorted((r.window_start, r.n_samples, r.peak_reserved_bytes) for r in spark.read.parquet(out).collect())
    # windows [0,1h) and [1h,2h) close; the late row never enters the first window
    assert [(n, p) for _, n, p in rows][:2] == [(2, 2), (1, 70)]


def test_convergence_runtime_ignores_session_dst(spark):
    """Wall-clock log times across the March clock change: 01:30 -> 03:30 is 2 h."""
    rows = [("r", 1, dt.datetime(2024, 3, 10, 1, 30), 1.0), ("r", 2, dt.datetime(2024, 3, 10, 3, 30), 0.5)]
    log = spark.createDataFrame(rows, "run_id string, step long, ts timestamp_ntz, loss double")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        r = telemetry.convergence(log).collect()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r.runtime_sec == 7200.0
