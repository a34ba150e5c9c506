"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_package_on_workers, scratch_path

#: A word is a run of characters other than space, tab, LF, VT, FF and CR.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers."""
    ensure_package_on_workers(spark)


def materialise(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: the lineage
    ends at files that every executor sees and that outlive a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def apart(df: DataFrame, *helpers: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with the columns that are named like one of an operator's helper columns renamed, and the names to give
    them back at the end."""
    taken = {c.lower() for c in (*df.columns, *helpers)}
    names = {}
    for c in df.columns:
        if c.lower() in {h.lower() for h in helpers}:
            k = 0
            while f"{c}__{k}".lower() in taken:
                k += 1
            names[c] = f"{c}__{k}"
            taken.add(names[c].lower())
    return df.withColumnsRenamed(names), {new: old for old, new in names.items()}


def words_of(text: Column | str) -> Column:
    """Array of the words of a text; null counts as empty."""
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")),
                                F.lit(f"({WORD_PATTERN})"))


def prefix_sums(df: DataFrame, order: list[Column], values: dict[str, str], name: str) -> DataFrame:
    """Running totals over a global order, without one task seeing all rows.

    ``values`` maps a numeric column to the name of its exclusive running total
    (what stands before the row). The rows are range-partitioned by ``order``
    and written; a window inside each range and the totals of the ranges before
    it (one row per range) give the result. ``order`` should be total: rows that
    tie in it are exchangeable and may land either way.
    """
    ranged = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    totals = ranged.groupBy("_range").agg(*[F.sum(v).alias(f"_t{i}") for i, v in enumerate(values)])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = totals.select("_range", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_b{i}")
                                      for i in range(len(values))])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.select("*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_w{i}")
                               for i, v in enumerate(values)])
    out = out.join(bases, "_range")
    return out.select(*[F.col(c) for c in df.columns],
                      *[(F.col(f"_w{i}") + F.col(f"_b{i}")).alias(o) for i, o in enumerate(values.values())])
