"""Training-run telemetry: loss convergence, peak memory, log tail, corpus size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import LOG_TAIL_LINES
from ..functions.metrics import round_exact
from ..functions.timefn import as_instant

GIB = float(1 << 30)


def convergence(log: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """First and final logged loss per run, with run time and loss summary.

    ``min_by``/``max_by`` combine partially, so a run holding most rows is
    still reduced map-side.
    """
    micros = F.unix_micros(as_instant(log, "ts"))
    return (log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_logged"),
        F.min("step").alias("first_step"),
        F.max("step").alias("last_step"),
        F.min_by("loss", "step").alias("first_loss"),
        F.max_by("loss", "step").alias("final_loss"),
        F.min("loss").alias("min_loss"),
        round_exact(F.avg("loss"), 6).alias("mean_loss"),
        ((F.max(micros) - F.min(micros)) / F.lit(1e6)).alias("runtime_sec"))
        .withColumn("loss_drop", F.col("first_loss") - F.col("final_loss")))


def peak_memory(samples: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Peak reserved memory in GiB (3 decimals) and its share of the total (2 decimals)."""
    agg = samples.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.max("reserved_bytes").alias("peak_reserved_bytes"),
        F.max("total_bytes").alias("total_bytes"))
    used = round_exact(F.col("peak_reserved_bytes") / F.lit(GIB), 3)
    total = round_exact(F.col("total_bytes") / F.lit(GIB), 3)
    return (agg.withColumn("used_gib", used).withColumn("total_gib", total)
            .withColumn("used_pct", F.when(F.col("total_gib") == 0, F.lit(None).cast("double"))
                        .otherwise(round_exact(F.col("used_gib") / F.col("total_gib") * F.lit(100.0), 2))))


def tail(log: DataFrame, n: int = LOG_TAIL_LINES, by: Sequence[str] = ("run_id",),
         order: str = "step") -> DataFrame:
    """Last ``n`` records per run.

    ``row_number() <= n`` lets the optimizer add a partial per-group limit
    before the shuffle, so a hot run ships at most ``n`` rows per task.
    """
    w = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return (log.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n).withColumn("rn", F.col("rn").cast("bigint")))
