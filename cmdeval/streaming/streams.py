"""Structured Streaming jobs: live log tail, running evaluation, telemetry windows.

Sinks are files in a shared folder with their own checkpoint, so a restarted
query resumes where it stopped and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import output_chars, round_exact, single_line
from ..functions.text import clean_command, strip
from ..operators.evaluate import failed_call
from ..operators.scoring import score_pairs
from ..sources.schemas import RUN_LOG_SCHEMA
from .increments import ANSWERS, IncrementTable, WindowTables, first_answers, running_answers


# Log files carry microsecond timestamps with an explicit zone.
LOG_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def tail_log(spark: SparkSession, source_dir: str, schema: T.StructType = RUN_LOG_SCHEMA,
             fmt: str = "json", run_ids: Sequence[str] | None = None, min_step: int | None = None,
             max_files_per_trigger: int | None = None) -> DataFrame:
    """``tail -f`` over a folder of log files: new records as they land."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "json":
        reader = reader.option("timestampFormat", LOG_TS_FORMAT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    df = reader.load(source_dir)
    if run_ids:
        df = df.where(F.col("run_id").isin(list(run_ids)))
    if min_step is not None:
        df = df.where(F.col("step") >= F.lit(min_step))
    return df


def running_evaluation(responses: DataFrame, suite: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Running per-(model, suite) sums over a stream of answers.

    Failed calls are left out; of the others the first to arrive counts (same
    model, suite, id inside the watermark), as in the batch evaluation. The stream joins the static suite; every metric is a projection of
    the joined row, so the aggregate is one stateful ``groupBy``.
    """
    answers = (responses.where(~failed_call(responses)).withWatermark("ts", watermark)
               .dropDuplicatesWithinWatermark(["model", "suite", "id"]))
    joined = answers.join(suite.select("suite", "id", "gold"), ["suite", "id"], "inner")
    raw = joined.withColumn("raw_prediction", F.coalesce(strip("raw_prediction"), F.lit("")))
    scored = score_pairs(raw.withColumn("clean_prediction", clean_command("raw_prediction")))
    return scored.groupBy("model", "suite").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("em").alias("sum_em"), F.sum("f1").alias("sum_f1"), F.sum("bleu4").alias("sum_bleu4"),
        F.sum(single_line("raw_prediction")).alias("sum_single_line"),
        F.sum("latency").alias("sum_latency"),
        F.sum(output_chars("raw_prediction")).alias("sum_chars"))


def running_evaluation_table(responses: DataFrame, suite: DataFrame, path: str, checkpoint: str,
                             compact_every: int = 16, timeout_sec: float | None = None) -> IncrementTable:
    """Score a stream of answers into a keyed table, to the end of what is available.

    The stream keeps no state: of each key the first answer by ``ts`` counts, however late or often it comes, since
    the table holds one row for each answered (model, suite, id). Failed calls are left out.
    """
    table = running_answers(responses.sparkSession, path, compact_every)

    def scored(batch: DataFrame, batch_id: int) -> None:
        answers = batch.where(~failed_call(batch)).select(
            "model", "suite", F.col("id").cast("bigint").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("latency").cast("double").alias("latency"),
            F.coalesce(strip("raw_prediction"), F.lit("")).alias("raw_prediction"))
        joined = first_answers(answers).join(suite.select("suite", "id", "gold"), ["suite", "id"], "inner")
        done = score_pairs(joined.withColumn("clean_prediction", clean_command("raw_prediction")), batches=True)
        done = done.withColumn("single_line", single_line("raw_prediction")).withColumn("output_chars", output_chars("raw_prediction"))
        table.add(done.select(*[f.split(" ")[0] for f in ANSWERS.split(", ")]), batch_id)

    _run_batches(responses, scored, checkpoint, timeout_sec)
    return table


def window_tables(samples: DataFrame, path: str, checkpoint: str, window: str = "1 hour", delay: str = "1 hour",
                  by: Sequence[str] = ("run_id",), end_marker: str | None = None, compact_every: int = 16,
                  timeout_sec: float | None = None) -> WindowTables:
    """Windows of a stream of samples to the end of what is available, late rows counted beside; see ``WindowTables``."""
    tables = WindowTables(samples.sparkSession, path, window, delay, list(by), compact_every)
    _run_batches(samples, lambda batch, batch_id: tables.add(batch, batch_id, end_marker), checkpoint, timeout_sec)
    return tables


def _run_batches(stream: DataFrame, fn, checkpoint: str, timeout_sec: float | None) -> None:
    _wait(stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(fn).start(), timeout_sec)


def _wait(query, timeout_sec: float | None) -> None:
    query.awaitTermination(timeout_sec)
    if query.isActive:
        query.stop()
        raise TimeoutError("stream did not drain in time")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def finish_running(totals: DataFrame) -> DataFrame:
    """Summary columns from running sums (same rounding as the batch summary)."""
    n = F.col("n")

    def pct(c):
        return round_exact(F.col(c) / n * F.lit(100.0), 2)

    return totals.select(
        "model", "suite", n.alias("num_samples"),
        pct("sum_em").alias("exact_match_pct"), pct("sum_f1").alias("mean_token_f1"),
        pct("sum_bleu4").alias("mean_bleu4"), pct("sum_single_line").alias("single_line_clean_pct"),
        round_exact(F.col("sum_latency") / n, 2).alias("avg_latency_sec"),
        round_exact(F.col("sum_chars") / n, 1).alias("avg_output_chars"))


def telemetry_windows(samples: DataFrame, window: str = "1 hour", watermark: str = "1 hour",
                      by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Tumbling event-time windows per run: sample count and peak reserved bytes.

    Rows older than the watermark are dropped (``window_tables`` counts them beside).
    In append mode a window is emitted once the watermark passes its end, in update
    mode whenever a micro-batch changes it.
    """
    return (samples.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_samples"),
                 F.max("reserved_bytes").alias("peak_reserved_bytes"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, "n_samples", "peak_reserved_bytes"))


def loss_windows(log: DataFrame, window: str = "1 hour", watermark: str = "1 hour",
                 by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Tumbling event-time windows of the training log per run: records,
    mean loss (6 decimals) and the loss of the last step in the window."""
    return (log.withWatermark("ts", watermark)
            .groupBy(F.window("ts", window).alias("w"), *by)
            .agg(F.count(F.lit(1)).alias("n_logged"),
                 round_exact(F.avg("loss"), 6).alias("mean_loss"),
                 F.max_by("loss", "step").alias("last_loss"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *by, "n_logged", "mean_loss", "last_loss"))


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last state of every group that an ``update`` run has written."""
    states = spark.read.parquet(path)
    values = [c for c in states.columns if c not in (*keys, "batch")]
    last = states.groupBy(*keys).agg(F.max(F.struct("batch", *values)).alias("s"))
    return last.select(*keys, *[F.col("s")[c].alias(c) for c in values])


def run_availablenow(stream: DataFrame, path: str, checkpoint: str, mode: str = "append",
                     timeout_sec: float | None = None) -> str:
    """Drain everything available into ``path`` and stop.

    ``append`` uses the Parquet file sink (exactly-once via its log).
    ``complete`` rewrites the whole result table per micro-batch, which is
    idempotent when a batch is retried. ``update`` writes the groups that a
    micro-batch changed to a folder of its own, open windows included; read the
    last state of each with ``latest``.
    """
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.outputMode("append").format("parquet").start(path)
    elif mode == "complete":
        def overwrite(batch: DataFrame, _batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(path)
        query = writer.outputMode("complete").foreachBatch(overwrite).start()
    elif mode == "update":
        def changed(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        query = writer.outputMode("update").foreachBatch(changed).start()
    else:
        raise ValueError(f"unsupported mode {mode!r}")
    _wait(query, timeout_sec)
    return path
