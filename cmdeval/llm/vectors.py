"""Inverted lists over vectors: what the near-dedup (1) and the search (8) share.

A vector takes part if it isn't null or zero, holds only finite components and
has the table's usual length. Equal vectors form one class: an index holds it
once, however many copies there are. Coarse centroids are fitted on the driver
to a bounded sample (``SAMPLE`` classes with the smallest hash); every class is
indexed. The number of lists follows the number of classes up to ``MAX_LISTS``,
so centroids always fit in a closure.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 16_384
MAX_LISTS = 4_096
PER_LIST = 128
#: Rows of one list that a task holds together, and rows compared with them at once.
CHUNK, BLOCK = 2_048, 8_192


def _usable(v: str) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, vec: str) -> tuple[DataFrame, int]:
    """Rows whose vector takes part, with a 128-bit key ``k1, k2`` of the vector, and the usual length."""
    good = df.where(F.col(vec).isNotNull() & (F.size(vec) > 0)).where(_usable(vec))
    usual = good.groupBy(F.size(vec).alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    dim = usual["n"] if usual else 0
    # 0.0 and -0.0 are one number
    same = F.transform(vec, lambda x: F.when(x == 0, F.lit(0).cast(df.schema[vec].dataType.elementType)).otherwise(x))
    return (good.where(F.size(vec) == dim)
            .withColumn("k1", F.xxhash64(F.lit(1), same)).withColumn("k2", F.xxhash64(F.lit(2), same))), dim


def dtype_of(df: DataFrame, vec: str) -> str:
    return "<f4" if df.schema[vec].dataType.elementType.simpleString() == "float" else "<f8"


def packed(column: pd.Series, dtype: str, dim: int) -> np.ndarray:
    """Vectors from a column of their bytes."""
    return np.frombuffer(b"".join(column), dtype).reshape(-1, dim).astype(np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * (x @ c.T), 0)


def balanced_kmeans(x: np.ndarray, k: int, rounds: int = 10, weight: float = 0.05, seed: int = 0) -> np.ndarray:
    """Centroids of lists of like size: a list that is too full counts as farther away."""
    rng = np.random.default_rng(seed)
    k = max(1, min(k, len(x)))
    c = x[np.sort(rng.choice(len(x), k, replace=False))].copy()
    full = np.zeros(k)
    for _ in range(rounds):
        near = np.concatenate([(squared_distances(b, c) + weight * full).argmin(1)
                               for b in np.array_split(x, max(1, len(x) * k // 4_000_000))])
        counts = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
        full = counts * k / len(x) - 1
    return np.unique(c, axis=0)


def sample_vectors(classes: DataFrame, dtype: str, dim: int, size: int = SAMPLE) -> np.ndarray:
    """A bounded, repeatable sample of the classes, on the driver (``size * dim`` numbers)."""
    rows = classes.select("k1", "k2", "vec").orderBy("k1", "k2").limit(size).collect()
    return unit(packed([bytes(r["vec"]) for r in rows], dtype, dim))


def pack_udf(dtype: str) -> Callable:
    @F.pandas_udf("binary")
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            yield pd.Series([np.asarray(v, dtype=dtype).tobytes() for v in column], dtype=object)
    return pack


def pieces_of(counts: dict[int, int], size: int) -> dict[int, int]:
    """Into how many pieces each list is split."""
    return {k: -(-n // size) for k, n in counts.items() if n > size}


def piece_column(pieces: dict[int, int], key: Column, salt: Column) -> Column:
    """The piece of its list that a row belongs to."""
    if not pieces:
        return F.lit(0)
    n = F.coalesce(F.try_element_at(F.create_map(*[F.lit(int(x)) for kv in pieces.items() for x in kv]), key), F.lit(1))
    return F.pmod(F.hash(salt), n).cast("int")


def all_pieces(pieces: dict[int, int], key: Column) -> Column:
    """Array of all pieces of a list, for the rows that meet each of them."""
    if not pieces:
        return F.array(F.lit(0))
    n = F.coalesce(F.try_element_at(F.create_map(*[F.lit(int(x)) for kv in pieces.items() for x in kv]), key), F.lit(1))
    return F.sequence(F.lit(0), n.cast("int") - 1)
