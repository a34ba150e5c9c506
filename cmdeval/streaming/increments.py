"""Keyed tables that micro-batches feed, each batch counted once.

Each batch writes its own folded rows to a folder named by its id: a batch that is delivered
again overwrites the same folder. Every ``compact_every`` batches the folders are folded into one
base, which holds each key once and names the last batch in it; a batch up to that one is known
already. So the table is as large as its keys and a bounded number of increments, however
long the stream, and the stream itself keeps no state. What a reader no longer needs is
removed one compaction later; a folder counts only once its writer has finished it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.metrics import SCORE_BITS, SECONDS_BITS, exact_sum


class IncrementTable:
    """``fold`` brings rows to one per key; folding what it has folded, with more rows, must give the same."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, fold: Callable[[DataFrame], DataFrame],
                 compact_every: int = 16):
        if compact_every < 1:
            raise ValueError("compact_every must be at least 1")
        self.spark, self.path, self.fold, self.compact_every = spark, path.rstrip("/"), fold, compact_every
        self.schema = schema

    def _finished(self, kind: str) -> dict[int, str]:
        """Finished folders of a kind by the batch that they name."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}")
        fs = root.getFileSystem(conf)
        if not fs.exists(root):
            return {}
        found = {}
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("batch=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found[int(name.removeprefix("batch="))] = f"{self.path}/{kind}/{name}"
        return found

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def upto(self) -> int:
        """The last batch of the base, -1 without one."""
        return max(self._finished("base"), default=-1)

    def holds(self, batch_id: int) -> bool:
        return batch_id <= self.upto() or batch_id in self._finished("part")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Count a batch; one that the base holds is left as it is."""
        upto = self.upto()
        if batch_id <= upto:
            return
        self.fold(batch).write.mode("overwrite").parquet(f"{self.path}/part/batch={batch_id}")
        if (batch_id + 1) % self.compact_every == 0:
            parts, bases = self._finished("part"), self._finished("base")
            self.current().write.mode("overwrite").parquet(f"{self.path}/base/batch={batch_id}")
            for folder in [f for b, f in parts.items() if b <= upto] + [f for b, f in bases.items() if b < upto]:
                self._remove(folder)

    def current(self) -> DataFrame:
        """The table now: one row per key."""
        bases = self._finished("base")
        upto = max(bases, default=-1)
        folders = [f for b, f in sorted(self._finished("part").items()) if b > upto]
        return self.fold(self._read(([bases[upto]] if bases else []) + folders))


# ---- running evaluation ----------------------------------------------------

ANSWER_KEYS = ["model", "suite", "id"]
METRICS = ["em", "f1", "bleu4", "single_line", "output_chars"]
ANSWERS = ("model string, suite string, id bigint, ts timestamp, latency double, raw_prediction string, em double, f1 double, "
           "bleu4 double, single_line int, output_chars bigint")


def first_answers(answers: DataFrame) -> DataFrame:
    """Of several answers to one key the first, by arrival, then latency and text, as in the batch evaluation."""
    rest = [c for c in answers.columns if c not in (*ANSWER_KEYS, "ts", "latency", "raw_prediction")]
    first = F.min(F.struct("ts", "latency", "raw_prediction", *rest)).alias("a")
    return answers.groupBy(*ANSWER_KEYS).agg(first).select(*ANSWER_KEYS, "a.*")


def running_answers(spark: SparkSession, path: str, compact_every: int = 16) -> IncrementTable:
    return IncrementTable(spark, path, ANSWERS, first_answers, compact_every)


def running_totals(answers: DataFrame) -> DataFrame:
    """Sums per (model, suite) of a table of first answers, for ``finish_running``."""
    scores = [exact_sum(F.col(c).cast("double"), SCORE_BITS).alias(f"sum_{c}") for c in ("em", "f1", "bleu4", "single_line")]
    return answers.groupBy("model", "suite").agg(
        F.count(F.lit(1)).alias("n"), *scores, exact_sum(F.col("latency"), SECONDS_BITS).alias("sum_latency"),
        F.sum("output_chars").alias("sum_chars"))


# ---- windows with late rows --------------------------------------------------

class WindowTables:
    """Event-time windows fed by micro-batches: counts and peaks per window, late rows per key, progress.

    A row is late when its window had ended ``delay`` before the latest time of the earlier batches; it is counted
    beside. Windows and late rows together are all rows, whatever the order of arrival. Rows without a time are late.
    """

    def __init__(self, spark: SparkSession, path: str, window: str, delay: str, by: list[str], compact_every: int = 16):
        self.window, self.delay, self.by = window, delay, by
        keys = ["window_start", "window_end", *by]
        of_by = ", ".join(f"{c} string" for c in by)
        self.windows = IncrementTable(
            spark, f"{path}/windows", f"window_start timestamp, window_end timestamp, {of_by}, n_samples bigint, peak_reserved_bytes bigint",
            lambda df: df.groupBy(*keys).agg(F.sum("n_samples").alias("n_samples"), F.max("peak_reserved_bytes").alias("peak_reserved_bytes")),
            compact_every)
        self.late = IncrementTable(spark, f"{path}/late", f"{of_by}, n_late bigint",
                                   lambda df: df.groupBy(*by).agg(F.sum("n_late").alias("n_late")), compact_every)
        self.progress = IncrementTable(spark, f"{path}/progress", "seen timestamp, ended boolean",
                                       lambda df: df.agg(F.max("seen").alias("seen"), F.max("ended").alias("ended")), compact_every)

    def watermark(self) -> tuple:
        """(time up to which windows have ended, whether the input has)."""
        row = self.progress.current().select(F.expr(f"seen - INTERVAL {self.delay}").alias("w"), "ended").first()
        return (row["w"], bool(row["ended"])) if row else (None, False)

    def add(self, batch: DataFrame, batch_id: int, end_marker: str | None = None) -> None:
        """Count a batch of (ts, reserved_bytes, keys); ``end_marker`` is a condition on rows that end the input and
        count nowhere. The progress is written last: a batch that has it is whole."""
        if self.progress.holds(batch_id):
            return
        marker = F.coalesce(F.expr(end_marker), F.lit(False)) if end_marker else F.lit(False)
        rows = batch.where(~marker).withColumn("w", F.window("ts", self.window))
        passed, _ = self.watermark()
        gone = F.coalesce(F.col("w.end") <= F.lit(passed), F.lit(False)) if passed is not None else F.lit(False)
        untimed = batch.where(~marker).where("ts IS NULL").select(*self.by, F.lit(1).cast("bigint").alias("n_late"))
        late = rows.where(gone).select(*self.by, F.lit(1).cast("bigint").alias("n_late")).unionByName(untimed)
        on_time = rows.where(~gone).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *self.by,
                                           F.lit(1).cast("bigint").alias("n_samples"), F.col("reserved_bytes").alias("peak_reserved_bytes"))
        self.windows.add(on_time, batch_id)
        self.late.add(late, batch_id)
        self.progress.add(batch.select(F.when(~marker, F.col("ts")).alias("seen"), marker.alias("ended")), batch_id)

    def current(self) -> DataFrame:
        """The windows now; ``closed`` where no row can change them any more."""
        passed, ended = self.watermark()
        closed = F.lit(True) if ended else F.coalesce(F.col("window_end") <= F.lit(passed), F.lit(False))
        return self.windows.current().withColumn("closed", closed)
