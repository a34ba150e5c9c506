"""Keyed tables fed by micro-batches: repeats, compaction, late rows, order of arrival."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cmdeval import streaming
from cmdeval.operators import evaluate
from cmdeval.session import scratch_path
from cmdeval.streaming.increments import IncrementTable, WindowTables

T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def test_a_batch_delivered_again_counts_once(spark):
    fold = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    path = scratch_path(spark, "inc")
    table = IncrementTable(spark, path, "k int, n bigint", fold, compact_every=3)
    assert table.current().count() == 0
    want = {}
    for b in range(11):
        rows = [(b % 4, 1), (0, 10), (0, 10)]
        batch = spark.createDataFrame(rows, "k int, n bigint")
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        table.add(batch, b)
        table.add(batch, b)  # the last batch again
        if b > 5:
            table.add(batch, b - 5)  # one that the base holds
        assert {r.k: r.n for r in table.current().collect()} == want, b
        local = path.removeprefix("file:")
        assert sum(len(os.listdir(f"{local}/{kind}")) for kind in ("part", "base") if os.path.isdir(f"{local}/{kind}")) <= 8
    again = IncrementTable(spark, path, "k int, n bigint", fold, compact_every=3)
    assert {r.k: r.n for r in again.current().collect()} == want and again.holds(10) and not again.holds(11)


def test_unfinished_base_is_not_read(spark):
    path = scratch_path(spark, "torn")
    table = IncrementTable(spark, path, "k int, n bigint", lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), compact_every=2)
    for b in range(2):
        table.add(spark.createDataFrame([(1, 1)], "k int, n bigint"), b)
    os.remove(f"{path.removeprefix('file:')}/base/batch=1/_SUCCESS")  # its writer was lost
    assert table.current().collect()[0].n == 2
    table.add(spark.createDataFrame([(1, 1)], "k int, n bigint"), 1)
    assert table.upto() == 1 and table.current().collect()[0].n == 2


def test_running_evaluation_counts_the_first_by_time(spark, tmp_path):
    suite = spark.createDataFrame([("s", i, "q", "ls") for i in range(4)], "suite string, id long, nl string, gold string")
    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[("m", "s", 0, "late answer", 1.0, False, at(50)), ("m", "s", 1, "", 0.0, True, at(1))],
               [("m", "s", 0, "ls", 2.0, False, at(5)), ("m", "s", 1, "ls", 3.0, False, at(9)), ("m", "s", 9, "ls", 1.0, False, at(1))],
               [("m", "s", 0, "ls", 2.0, False, at(5)), ("m", "s", 2, None, 1.0, None, at(2))]]
    schema = "model string, suite string, id long, raw_prediction string, latency double, is_error boolean, ts timestamp"
    src, every = str(tmp_path / "in"), []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{src}/b={k}")
        every += rows
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    table = streaming.running_evaluation_table(stream, suite, str(tmp_path / "out"), str(tmp_path / "ck"), compact_every=2)
    rows = {r.id: (r.raw_prediction, r.em, r.latency) for r in table.current().collect()}
    assert rows == {0: ("ls", 1.0, 2.0), 1: ("ls", 1.0, 3.0)}
    got = streaming.finish_running(streaming.running_totals(table.current())).collect()[0]
    batch = evaluate.score(suite, spark.createDataFrame(every, schema), ["m"]).where("NOT is_error")
    want = evaluate.summarise(batch).collect()[0]
    assert got.asDict() == {c: want[c] for c in got.asDict()}


def test_late_rows_are_counted_and_an_end_marker_closes(spark):
    path = scratch_path(spark, "late")
    tables = WindowTables(spark, path, "1 hour", "30 minutes", ["run_id"], compact_every=2)
    schema = "run_id string, ts timestamp, reserved_bytes bigint"
    at = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[("r", at(10), 5), ("r", at(20), 7), (None, at(5), 1)], [("r", at(200), 1), ("r", at(30), 9)],
               [("r", at(40), 99), ("r", at(150), 2), ("r", at(179), 3), ("r", None, 4)], [("end", at(999), 0)]]
    closed = []
    for b, rows in enumerate(batches):
        for _ in range(2):  # each batch twice
            tables.add(spark.createDataFrame(rows, schema), b, end_marker="run_id = 'end'")
        closed.append(tables.current().where("closed").count())
    got = {(r.run_id, r.window_start.replace(tzinfo=dt.timezone.utc).hour): (r.n_samples, r.peak_reserved_bytes, r.closed)
           for r in tables.current().collect()}
    # The third batch comes when 02:50 has passed: the window from 02:00 is open yet, that from 00:00 is not.
    assert got == {("r", 0): (3, 9, True), (None, 0): (1, 1, True), ("r", 3): (1, 1, True), ("r", 2): (2, 3, True)}
    late = {r.run_id: r.n_late for r in tables.late.current().collect()}
    assert sum(n for n, _, _ in got.values()) + sum(late.values()) == 9 and late == {"r": 2}
    assert closed[0] == 0 and closed[1] == closed[2] == 2 and closed[3] == 4
