"""Positions in a global order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_package_on_workers, scratch_path


def ranked(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """``df`` with ``out``: the 1-based place of each row in the order.

    Rows are range-partitioned, sorted inside their range and written, a file a range. A row's place is its index in
    that file after the rows of the ranges before it (one small row per range), so nothing is sorted twice and no
    window runs over rows. The order should be total; rows that tie may come either way.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "ranked")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    placed.write.option("maxRecordsPerFile", 0).parquet(path)
    written = spark.read.schema(placed.schema).parquet(path)
    sizes = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    bases = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rank = (F.col("_base") + F.col("_at") + 1).cast("bigint").alias(out)
    return (written.select("*", F.col("_metadata.row_index").alias("_at")).join(bases, "_range")
            .select(*[F.col(c) for c in df.columns if c != out], rank))


def numbered(df: DataFrame, keys: Sequence[str], file: str, block: str, at: str, out: str) -> DataFrame:
    """``df`` with ``out``: 1-based numbers inside each key, in the order of files, their blocks, and places in them.

    Rows are numbered inside a block (bounded by the reader's splits); the blocks before it are counted from a small
    table with a row for each key and block.
    """
    inside = F.row_number().over(Window.partitionBy(*keys, file, block).orderBy(at))
    numbers, bases = df.withColumn("_inside", inside), _before(df, keys, file, block)
    return _from_bases(numbers, bases, [*keys, file, block], [c for c in df.columns if c != out], out)


def numbered_as_read(df: DataFrame, keys: Sequence[str], file: str, block: str, out: str) -> DataFrame:
    """``numbered`` of rows as a reader gives them: each block by one task, in its order.

    The task counts on from row to row, so no row crosses the network; it is given the key, file and block only.
    """
    ensure_package_on_workers(df.sparkSession)
    inside = F.arrow_udf(running_counts, "bigint").asNondeterministic()  # hangs on the rows before
    numbers, bases = df.withColumn("_inside", inside(*keys, file, block)), F.broadcast(_before(df, keys, file, block))
    return _from_bases(numbers, bases, [*keys, file, block], [c for c in df.columns if c != out], out)


def _before(df: DataFrame, keys: Sequence[str], file: str, block: str) -> DataFrame:
    """A row for each key and block: how many rows of the key the blocks before it have."""
    sizes = df.groupBy(*keys, file, block).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)  # rows: blocks
    return sizes.select(*keys, file, block, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))


def _from_bases(numbers: DataFrame, bases: DataFrame, by: Sequence[str], columns: Sequence[str], out: str) -> DataFrame:
    on = F.lit(True)
    for c in by:
        on = on & numbers[c].eqNullSafe(bases[c])
    return numbers.join(bases, on).select(*[numbers[c] for c in columns],
                                          (F.col("_base") + F.col("_inside")).cast("bigint").alias(out))


def running_counts(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """For each row how many rows with its values came up to it, itself included."""
    seen: dict[tuple, int] = {}
    for columns in batches:
        codes = np.zeros(len(columns[0]), np.int64)
        for c in columns:
            values = c.dictionary_encode(null_encoding="encode")
            codes, _ = pd.factorize(codes * max(1, len(values.dictionary)) + values.indices.to_numpy())
        found, first, sizes = np.unique(codes, return_index=True, return_counts=True)
        names = [tuple(c[int(i)].as_py() for c in columns) for i in first]
        before = np.array([seen.get(name, 0) for name in names], np.int64)
        yield pa.array(before[codes] + pd.Series(codes).groupby(codes).cumcount().to_numpy() + 1, pa.int64())
        for name, old, n in zip(names, before, sizes):
            seen[name] = int(old + n)
