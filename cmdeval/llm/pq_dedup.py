"""Operator 1: embedding near-dedup by product quantisation over inverted lists.

Each distinct vector lies in the list of its nearest coarse centroid, as codes
of its residual: one of ``CODEWORDS`` codewords in each of ``SUBSPACES`` parts.

Probes. Let x lie in list A, y in list B, at distance d. How far each lies on
its own side of the plane between the two centroids adds up to at most d, so
the smaller of the two is at most d / 2. Every vector therefore visits all lists
whose plane is within half the distance that the cosine limit allows: no link
can be missed. A pair that meets in both lists counts in the lower one.

Distances. In a list, table lookups give the distance between a visitor and
each coded vector; the pair is a candidate if that is at most the limit plus
the coded vector's own quantisation error (stored beside the codes), again
without loss. Candidates are decided by their exact cosine in double precision.

A task sees one piece of a list and one block of its visitors, adds up links
for each vector and sends on a spanning forest of the links it found, not the
links: output is linear in its input, also where thousands of vectors all
resemble each other. Equal vectors form one class with a multiplicity.

Every row counts as a vector. Vectors null, zero, with null or non-finite
components or of an unusual length link with nothing. Rows with a null id take
part; their component is the smallest id that is not null. An empty table gives
an empty result. Codebooks and centroids are fitted to a bounded sample
(``vectors.SAMPLE``); no result depends on the fit, only the time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship
from .components import connected_components
from .vectors import (BLOCK, CHUNK, MAX_LISTS, PER_LIST, all_pieces, balanced_kmeans, dtype_of, pack_udf, packed,
                      piece_column, pieces_of, sample_vectors, squared_distances, unit, usable)

SIMILARITY = 0.95
SUBSPACES = 8
CODEWORDS = 256
SLACK = 1e-6


class Quantiser:
    """Coarse centroids and residual codebooks."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centroids = balanced_kmeans(sample, lists)
        residuals = sample - self.centroids[squared_distances(sample, self.centroids).argmin(1)]
        self.parts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [balanced_kmeans(residuals[:, p], CODEWORDS, rounds=6, weight=0.0, seed=1 + i)
                      for i, p in enumerate(self.parts)]
        gaps = np.sqrt(squared_distances(self.centroids, self.centroids))
        np.fill_diagonal(gaps, 1.0)
        self.gaps = np.maximum(gaps, 1e-12)

    def place(self, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and which lists it visits (own included)."""
        d = squared_distances(x, self.centroids)
        own = d.argmin(1)
        plane = (d - d[np.arange(len(x)), own][:, None]) / (2 * self.gaps[own])
        visits = plane <= reach
        visits[np.arange(len(x)), own] = True
        return own, visits

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the length of what the codes leave out."""
        codes = np.stack([squared_distances(residuals[:, p], b).argmin(1) for p, b in zip(self.parts, self.books)], axis=1)
        kept = np.concatenate([b[codes[:, i]] for i, b in enumerate(self.books)], axis=1)
        return codes.astype(np.uint8), np.sqrt(((residuals - kept) ** 2).sum(1))

    def lookup(self, residuals: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Distances between residuals and coded residuals, by table."""
        total = np.zeros((len(residuals), len(codes)), dtype=np.float32)
        for i, (p, b) in enumerate(zip(self.parts, self.books)):
            total += squared_distances(residuals[:, p], b).astype(np.float32)[:, codes[:, i]]
        return np.sqrt(total)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each node's component, by hooking and pointer jumping."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        live = ra != rb
        if not live.any():
            return root
        a, b, ra, rb = a[live], b[live], ra[live], rb[live]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(jumped := root[root], root):
            root = jumped


def near_duplicates(vectors: DataFrame, similarity: float = SIMILARITY, vec_id: str = "vec_id",
                    vec: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``vectors``."""
    spark = vectors.sparkSession
    ship(spark)
    kind = dtype_of(vectors, vec)
    source = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vec).alias("v"))
    good, dim = usable(source, "v")
    alone = source.select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    if not dim:
        return _named(alone, vec_id)
    keyed = good.select("id", "k1", "k2", "v")
    classes = materialise(keyed.groupBy("k1", "k2").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"),
                                                        F.min("v").alias("v"))
                          .select("k1", "k2", "first", "copies", pack_udf(kind)("v").alias("vec")), "pq-classes")
    # A node is a class, named by its hash; 64 bits of it order the pairs inside a task.
    quantiser = Quantiser(sample_vectors(classes, kind, dim), max(1, min(MAX_LISTS, classes.count() // PER_LIST)))
    distance = float(np.sqrt(max(0.0, 2 - 2 * similarity)))

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = unit(packed(b["vec"], kind, dim))
            own, visits = quantiser.place(x, distance / 2 + SLACK)
            codes, left = quantiser.encode(x - quantiser.centroids[own])
            yield pd.DataFrame({"k1": b["k1"], "k2": b["k2"], "copies": b["copies"], "vec": b["vec"], "own": own,
                                "visits": [np.flatnonzero(v).tolist() for v in visits],
                                "codes": [c.tobytes() for c in codes], "error": left})

    fields = "k1 bigint, k2 bigint, copies bigint, vec binary, own int, visits array<int>"
    indexed = materialise(classes.select("k1", "k2", "copies", "vec").mapInPandas(
        index, f"{fields}, codes binary, error double"), "pq-index")
    visiting = indexed.withColumn("list", F.explode("visits"))
    # One number for each list, MAX_LISTS at most.
    chunks = pieces_of({r["own"]: r["count"] for r in indexed.groupBy("own").count().collect()}, CHUNK)
    blocks = pieces_of({r["list"]: r["count"] for r in visiting.groupBy("list").count().collect()}, BLOCK)
    key = F.col("list")
    visitors = (visiting.withColumn("block", piece_column(blocks, key, F.col("k1")))
                .withColumn("chunk", F.explode(all_pieces(chunks, key)))
                .select("list", "chunk", "block", "k1", "k2", "copies", "vec", "own"))
    members = (indexed.withColumn("list", F.col("own")).withColumn("chunk", piece_column(chunks, key, F.col("k1")))
               .withColumn("block", F.explode(all_pieces(blocks, key)))
               .select("list", "chunk", "block", "k1", "k2", "copies", "vec", "visits", "codes", "error"))

    def link(v: pd.DataFrame, m: pd.DataFrame) -> pd.DataFrame:
        out = {"k1": [], "k2": [], "links": [], "r1": [], "r2": []}
        if len(v) and len(m):
            here = int(m["list"].iloc[0])
            y = unit(packed(m["vec"], kind, dim))
            codes = np.frombuffer(b"".join(m["codes"]), np.uint8).reshape(len(m), -1)
            limit = (distance + SLACK + m["error"].to_numpy()).astype(np.float32)[None]
            seen = np.zeros((len(m), len(quantiser.centroids)), dtype=bool)
            seen[np.repeat(np.arange(len(m)), m["visits"].map(len)), np.concatenate(m["visits"].to_numpy())] = True
            x = unit(packed(v["vec"], kind, dim))
            own = v["own"].to_numpy()
            vk, mk = (np.stack([d["k1"].to_numpy(), d["k2"].to_numpy()], 1) for d in (v, m))
            ii, jj = [], []
            for lo in range(0, len(v), 1024):
                part = x[lo:lo + 1024]
                i, j = np.nonzero(quantiser.lookup(part - quantiser.centroids[here], codes) <= limit)
                exact = np.concatenate([np.einsum("nd,nd->n", part[i[s:s + 65536]], y[j[s:s + 65536]])
                                        for s in range(0, len(i), 65536)] or [np.zeros(0)]) >= similarity
                i, j = i[exact] + lo, j[exact]
                # Members of this list: each pair once. Others: unless the pair counts in a lower list.
                before = (vk[i, 0] < mk[j, 0]) | ((vk[i, 0] == mk[j, 0]) & (vk[i, 1] < mk[j, 1]))
                once = np.where(own[i] == here, before, ~(seen[j, own[i]] & (own[i] < here)))
                ii.append(i[once])
                jj.append(j[once])
            i, j = np.concatenate(ii), np.concatenate(jj)
            keys, node = np.unique(np.concatenate([vk, mk]), axis=0, return_inverse=True)
            node = node.reshape(-1)
            a, b = node[i], node[len(v) + j]
            weight = np.concatenate([v["copies"].to_numpy(), m["copies"].to_numpy()])
            links = np.bincount(a, weight[len(v) + j], len(keys)) + np.bincount(b, weight[i], len(keys))
            root = _roots(len(keys), a, b)
            some = np.flatnonzero(links)
            for c, got in zip(out, (keys[some, 0], keys[some, 1], links[some].astype(np.int64),
                                    keys[root[some], 0], keys[root[some], 1])):
                out[c].append(got)
        return pd.DataFrame({c: np.concatenate(x) if x else [] for c, x in out.items()})

    found = materialise(visitors.groupBy("list", "chunk", "block").cogroup(members.groupBy("list", "chunk", "block"))
                        .applyInPandas(link, "k1 bigint, k2 bigint, links bigint, r1 bigint, r2 bigint"), "pq-links")
    counts = found.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.struct("k1", "k2").alias("a"),
                                              F.struct(F.col("r1").alias("k1"), F.col("r2").alias("k2")).alias("b")), "pq")
    parts = materialise(parts.select("node.k1", "node.k2", "component"), "pq-parts")
    named = (classes.select("k1", "k2", "first", "copies").join(parts, ["k1", "k2"], "left")
             .withColumn("component", F.coalesce("component", F.struct("k1", "k2"))))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    done = (named.join(smallest, "component").join(counts, ["k1", "k2"], "left")
            .select("k1", "k2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")))
    linked = keyed.select("id", "k1", "k2").join(done, ["k1", "k2"]).select("id", F.col("links").alias("n_links"), "component_id")
    rest = _unusable(source, dim)
    return _named(linked.union(rest.select("id", F.lit(0).cast("bigint"), F.col("id"))), vec_id)


def _unusable(source: DataFrame, dim: int) -> DataFrame:
    from .vectors import _usable

    return source.where(~F.coalesce(_usable("v") & (F.size("v") == dim), F.lit(False)))


def _named(rows: DataFrame, vec_id: str) -> DataFrame:
    return rows.select(F.col("id").alias(vec_id), F.col("n_links").cast("bigint").alias("n_links"), "component_id",
                       F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
