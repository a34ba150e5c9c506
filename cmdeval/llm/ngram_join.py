"""Operator 10: n-gram Jaccard join by universe partition and pigeonhole.

A document's set is its distinct ``n``-word shingles (ASCII lower case, words
parted by white space), as 64-bit hashes; fewer words give one shingle of the
whole sequence, no words the empty set, which links with nothing. Documents
with equal sets form one class, named by a hash of the set.

Size bands. A band's upper size is the one below it divided by the similarity,
so a link joins sets of one band or of two neighbours: each set signs for its
own band and the next. In a band, two linked sets differ in at most ``H``
shingles. The universe is hashed into segments, and by the pigeonhole principle

* with ``H + 1 + k`` segments at least ``k + 1`` of them hold equal subsets; each
  set leaves out its ``k`` smallest segments (by size, then place), and the
  largest of the equal ones is left out by neither side;
* with units ``v`` of 1 or 2 that add up to ``H + 1``, some segment differs in
  fewer than ``v`` shingles: its subset, or the subset and its one-deletion
  neighbourhood, meet.

Which of the two a band uses is decided by cost, from the number of documents
of each size in the whole corpus: signatures to shuffle against chance meetings
to verify. No link can be missed; candidates are verified exactly.

Signatures travel as packed blocks, a copy met before in a task is not signed
again, and a signature that no other class has ends in the task that sorts it.
Only components are asked for, so not every pair of a bucket is verified: first
each class with the smallest class it shares a bucket with; then, only in
buckets that still hold several components, each class with one class of each of
the ``FEW`` smallest other components it meets there, again while that finds
links, ``ROUNDS`` times at most; at last all pairs across the components that
are left. Such a bucket is split into blocks of about ``BLOCK`` classes, and a
pair of blocks is what a task holds.

Every set has a sketch: its shingles are thrown into cells, a bit for each cell
tells whether their number is odd. Two sets differ in at least as many shingles
as their sketches in bits, so pairs whose sketches differ in more than a link
may are settled by counting bits. Only the others become rows and are verified.

Null text is empty. Rows that repeat an id are documents of their own. A null id
takes part; a component's id is its smallest id that is not null. An empty table
gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, ship
from .components import connected_components

N = 4
SIMILARITY = 85  # per cent
#: Share of a set's shingles that an unrelated document is taken to hold too, for the cost model.
COMMON = 0.1
FLUSH = 500_000
GROUPS_PER_PARTITION = 8
GROUP_CHARS = 1 << 20
BLOCK = 1_024
FEW, ROUNDS = 2, 2
#: Fewest cells of a sketch; sets of more shingles have as many cells as shingles, or up to twice as many.
CELLS = 1_024

_M = np.uint64(0xFF51AFD7ED558CCD)
_K = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole word."""
    x = (x ^ (x >> np.uint64(33))) * _M
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], n: int = N) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    from xxhash import xxh64_intdigest

    out = []
    with np.errstate(over="ignore"):
        for t in texts:
            words = t.encode("utf-8", "replace").lower().split() if t else []
            w = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
            width = min(n, len(w))
            if not width:
                out.append(w)
                continue
            h = np.full(len(w) - width + 1, np.uint64(width))
            for i in range(width):
                h = mixed(h * _K + w[i:len(w) - width + 1 + i])
            out.append(np.unique(h))
    return out


def set_name(s: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    with np.errstate(over="ignore"):
        total = np.array([np.add.reduce(mixed(s + _K), dtype=np.uint64) + np.uint64(len(s))], dtype=np.uint64)
    return int(mixed(total).view(np.int64)[0])


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the number of a set's shingles in each cell, 64 cells a word."""
    cells = CELLS
    while cells < len(s):
        cells *= 2
    with np.errstate(over="ignore"):
        place = (mixed(s ^ _K) % np.uint64(cells)).astype(np.int64)
    odd = (np.bincount(place, minlength=cells) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(x: np.ndarray, words: int) -> np.ndarray:
    """The sketch of the same set with fewer cells (cells are numbered by a remainder)."""
    return x if len(x) == words else np.bitwise_xor.reduce(x.reshape(-1, words), axis=0)


def may_link(n: int, x: np.ndarray, m: np.ndarray, y: np.ndarray, similarity: int) -> np.ndarray:
    """Whether a set of ``n`` shingles and sketch ``x`` may link with those of ``m`` shingles and sketches ``y``."""
    differ = np.bitwise_count(y ^ x).sum(axis=1, dtype=np.int64)
    return differ * (100 + similarity) <= (n + m) * (100 - similarity)


def band_tops(largest: int, similarity: int) -> list[int]:
    """Upper sizes of the bands up to one that holds ``largest``, and one more."""
    tops = [1]
    while len(tops) < 2 or tops[-2] < largest:
        tops.append(max(tops[-1] + 1, tops[-1] * 100 // similarity))
    return tops


class Plan:
    """How the sets of each band are signed."""

    def __init__(self, counts: dict[int, int], largest: int, similarity: int):
        """``counts``: documents of each size, about; no set has more than ``largest`` shingles."""
        self.tops = np.array(band_tops(max(largest, *counts, 1), similarity))
        sizes = np.array(sorted(counts), dtype=np.int64)
        held = np.zeros(len(self.tops) + 1)
        np.add.at(held, np.searchsorted(self.tops, sizes), [counts[int(s)] for s in sizes])
        self.bands = []
        for b, top in enumerate(self.tops.tolist()):
            differ = 2 * top * (100 - similarity) // (100 + similarity)
            spare = (differ + 1) // 4
            exact = differ + 1 + spare
            twos, ones = (differ + 1) // 2, (differ + 1) % 2
            n = held[b] + held[b - 1]
            chance = lambda elements: COMMON ** max(0.0, elements)
            cost_exact = n * (differ + 1) + n * n / 2 * (differ + 1) * chance(top / exact)
            cost_near = n * (twos + ones + top) + n * n / 2 * (twos + ones) * top / (twos + ones) * chance(top / (twos + ones) - 1)
            self.bands.append(("exact", exact, spare) if cost_exact <= cost_near else ("near", twos + ones, twos))

    def band(self, size: int) -> int:
        return int(np.searchsorted(self.tops, size))

    def sign(self, s: np.ndarray) -> np.ndarray:
        """Signatures of a set in its own band and the next."""
        own = self.band(len(s))
        out = []
        with np.errstate(over="ignore"):
            for b in range(own, min(own + 2, len(self.tops))):
                kind, m, extra = self.bands[b]
                salt = np.uint64(b + 1) * _K
                h = mixed(s + salt)
                place = ((h >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
                count = np.bincount(place, minlength=m)
                # Exact sums of 64-bit numbers, by halves (a set has far fewer than 2 ** 21 shingles in a segment).
                low = np.bincount(place, (h & np.uint64(0xFFFFFFFF)).astype(np.float64), m).astype(np.uint64)
                high = np.bincount(place, (h >> np.uint64(32)).astype(np.float64), m).astype(np.uint64)
                total = (high << np.uint64(32)) + low
                tag = mixed(np.arange(m, dtype=np.uint64) + salt)
                whole = mixed(total + tag + count.astype(np.uint64))
                if kind == "exact":
                    keep = np.lexsort((np.arange(m), count))[extra:]
                    out.append(whole[keep])
                else:
                    near = place < extra  # the first segments count two units
                    p = place[near]
                    out += [whole, mixed(total[p] - h[near] + tag[p] + (count[p] - 1).astype(np.uint64))]
        return np.unique(np.concatenate(out))


def _packets(groups: int, sigs: list, names: list, bands: list) -> Iterator[dict]:
    """Signatures with the name and band of their sets, packed by the group that sorts them."""
    owner = np.repeat(np.arange(len(sigs)), [len(x) for x in sigs])
    s = np.concatenate(sigs)
    group = ((s >> np.uint64(8)) % np.uint64(groups)).astype(np.int32)
    order = np.argsort(group, kind="stable")
    s, owner, group = s[order], owner[order], group[order]
    name, band = np.array(names, dtype=np.int64)[owner], np.array(bands, dtype=np.uint8)[owner]
    edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    for lo, hi in zip(edges, [*edges[1:], len(group)]):
        yield {"p": int(group[lo]), "kind": 1, "ids": None, "sketches": None,
               "data": s[lo:hi].tobytes() + name[lo:hi].tobytes() + band[lo:hi].tobytes()}


def _unpacked(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [(b, len(b) // 17) for b in blocks]
    return (np.concatenate([np.frombuffer(b, np.uint64, n) for b, n in parts]),
            np.concatenate([np.frombuffer(b, np.int64, n, 8 * n) for b, n in parts]),
            np.concatenate([np.frombuffer(b, np.uint8, n, 16 * n) for b, n in parts]))


def _rows(records: list[dict], columns: list[str]) -> pd.DataFrame:
    kinds = {"ids": object, "data": object, "sketch": object, "sketches": object, "members": object, "bucket": "Int64",
             "head": "Int64", "doc": "Int64", "name": "Int64", "n": "Int64", "key": "Int64"}
    return pd.DataFrame({c: pd.Series([r[c] for r in records], dtype=kinds.get(c, "int64")) for c in columns})


def _buckets(docs: DataFrame, n: int, similarity: int) -> DataFrame:
    """kind 0: a row for each document; kind 1: classes that share a signature."""
    spark = docs.sparkSession
    # Sizes by the number of spaces, for the costs alone, in steps that are finer than the bands: a few hundred rows,
    # whatever the corpus.
    size = F.octet_length("t") - F.octet_length(F.replace("t", F.lit(" "))) + 2 - n
    step = F.floor(F.log(F.greatest(size, F.lit(1)).cast("double")) * 50)
    found = (docs.groupBy(step.alias("s")).agg(F.max(size).alias("top"), F.count(F.lit(1)).alias("n"),
                                               F.max(F.octet_length("t")).alias("bytes")).collect())
    largest = max((r["bytes"] or 0 for r in found), default=0) // 2 + 1
    plan = Plan({max(1, r["top"] or 0): r["n"] for r in found}, largest, similarity)
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        met: set[int] = set()
        turn = 0
        for b in batches:
            texts, keys, ids = b["t"].tolist(), b["key"].tolist(), [None if pd.isna(i) else int(i) for i in b["id"]]
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and chars < GROUP_CHARS:
                    chars += len(texts[hi] or "")
                    hi += 1
                sets = shingle_sets(texts[lo:hi], n)
                names = [set_name(s) for s in sets]
                sigs, owners, sizes, out = [], [], [], []
                held = 0
                for s, name in zip(sets, names):
                    if len(s) and name not in met:
                        if len(met) > 200_000:
                            met.clear()
                        met.add(name)
                        sigs.append(plan.sign(s))
                        owners.append(name)
                        sizes.append(plan.band(len(s)))
                        held += len(sigs[-1])
                    if held > FLUSH:
                        out += _packets(groups, sigs, owners, sizes)
                        sigs, owners, sizes, held = [], [], [], 0
                if sigs:
                    out += _packets(groups, sigs, owners, sizes)
                turn += 1
                out.append({"p": turn * 7919 % groups, "kind": 0, "ids": ids[lo:hi],
                            "sketches": [sketch(s).tobytes() for s in sets],
                            "data": np.array([[a, len(s), k] for a, s, k in zip(names, sets, keys[lo:hi])],
                                             dtype=np.int64).tobytes()})
                yield _rows(out, ["p", "kind", "ids", "data", "sketches"])
                lo = hi

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for r in group[group["kind"] == 0].itertuples():
            data = np.frombuffer(r.data, np.int64).reshape(-1, 3)
            out += [{"kind": 0, "doc": None if i is None or i != i else int(i), "name": a, "n": k, "key": t, "sketch": x, "bucket": None,
                     "head": None, "members": None} for i, (a, k, t), x in zip(r.ids, data.tolist(), r.sketches)]
        blocks = group.loc[group["kind"] == 1, "data"]
        if len(blocks):
            sig, name, band = _unpacked(list(blocks))
            order = np.lexsort((name, sig))
            sig, name, band = sig[order], name[order], band[order]
            fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])])
            sig, name, band = sig[fresh], name[fresh], band[fresh].astype(np.int64)
            edges = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
            ends = np.append(edges[1:], len(sig))
            bare = dict.fromkeys(("doc", "name", "n", "key", "sketch"))
            seen: set[int] = set()
            for lo, hi in zip(*(x[ends - edges > 1].tolist() for x in (edges, ends))):
                # Without two bands near enough for a link the classes met by chance.
                if (np.diff(np.sort(band[lo:hi])) <= 1).any() and (bucket := set_name(name[lo:hi].view(np.uint64))) not in seen:
                    seen.add(bucket)
                    out += [{"kind": 1, **bare, "bucket": bucket, "head": int(name[lo]),
                             "members": name[at:min(at + BLOCK, hi)].tolist()} for at in range(lo, hi, BLOCK)]
        return _rows(out, ["kind", "doc", "name", "n", "key", "sketch", "bucket", "head", "members"])

    packets = docs.mapInPandas(signed, "p int, kind int, ids array<bigint>, data binary, sketches array<binary>")
    return materialise(packets.groupBy("p").applyInPandas(
        meet, "kind int, doc bigint, name bigint, n bigint, key bigint, sketch binary, bucket bigint, head bigint, members array<bigint>"),
        "ngram-buckets")


def _likely(pairs: DataFrame, sized: DataFrame, similarity: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sizes and sketches leave a link possible."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            for n, m, x, y in zip(b["n"], b["m"], b["x"], b["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                words = min(len(x), len(y))
                keep.append(min(n, m) * 100 >= max(n, m) * similarity and bool(
                    may_link(n, folded(x, words), np.array([m]), folded(y, words)[None, :], similarity)[0]))
            yield b.loc[keep, ["a", "b"]]

    both = (pairs.join(sized.select(F.col("name").alias("a"), "n", F.col("sketch").alias("x")), "a")
            .join(sized.select(F.col("name").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y")), "b"))
    return materialise(both.select("a", "b", "n", "m", "x", "y").mapInPandas(check, "a bigint, b bigint"), name)


def _across(placed: DataFrame, similarity: int, name: str, few: int | None = None) -> DataFrame:
    """Pairs (a, b) of classes of different components that share a bucket and may link.

    With ``few``, of those of a class in a pair of blocks one for each of the ``few`` smallest components.
    ``placed`` has (bucket, name, n, sketch, part). Buckets with several components are split into blocks by a hash of
    the class; a task holds pairs of blocks.
    """
    spark = placed.sparkSession
    several = (placed.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"),
                                            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
               .where("lo <> hi").select("bucket", "blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    blocks = (placed.join(several, "bucket").withColumn("own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
              .withColumn("other", other).withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    groups = GROUPS_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        found: set[tuple[int, int]] = set()
        group = group.sort_values(["bucket", "i", "j", "n", "name"], ignore_index=True)
        names, sizes, parts, own = (group[c].to_numpy() for c in ("name", "n", "part", "own"))
        keys = group[["bucket", "i", "j"]].to_numpy()
        edges = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
        for lo, hi in zip(edges, [*edges[1:], len(group)]):
            if (parts[lo:hi] == parts[lo]).all():
                continue
            name, n, part, side = names[lo:hi], sizes[lo:hi], parts[lo:hi], own[lo:hi]
            two = keys[lo, 1] != keys[lo, 2]
            raw = [np.frombuffer(x, np.uint64) for x in group["sketch"].iloc[lo:hi]]
            words = min(map(len, raw))
            sk = np.stack([folded(x, words) for x in raw])
            top = np.searchsorted(n, n * 100 // similarity, side="right")  # sizes near enough
            for x in range(len(n) - 1):
                y = np.arange(x + 1, top[x])
                y = y[(part[y] != part[x]) & ((side[y] != side[x]) if two else True)]
                if len(y):
                    y = y[may_link(n[x], sk[x], n[y], sk[y], similarity)]
                    if few:
                        y = y[np.unique(part[y], return_index=True)[1][:few]]
                    found.update((max(name[x], z), min(name[x], z)) for z in name[y].tolist())
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    columns = ["bucket", "i", "j", "own", "name", "n", "part", "sketch"]
    spread = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(groups)).cast("int").alias("p")
    return materialise(blocks.select(spread, *columns).groupBy("p").applyInPandas(meet, "a bigint, b bigint").distinct(), name)


def _verified(pairs: DataFrame, docs: DataFrame, named: DataFrame, n: int, similarity: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sets link."""
    sets = _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct(), named, n)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keep = []
            for x, y in zip(b["x"], b["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if min(len(x), len(y)) * 100 < max(len(x), len(y)) * similarity:
                    keep.append(False)
                    continue
                common = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * common >= similarity * (len(x) + len(y) - common))
            yield b.loc[keep, ["a", "b"]]

    both = (pairs.join(sets.select(F.col("name").alias("a"), F.col("data").alias("x")), "a")
            .join(sets.select(F.col("name").alias("b"), F.col("data").alias("y")), "b").select("a", "b", "x", "y"))
    return materialise(both.mapInPandas(check, "a bigint, b bigint"), name)


def _sets(docs: DataFrame, wanted: DataFrame, named: DataFrame, n: int) -> DataFrame:
    """(name, data): the sets of the classes ``wanted``, made again from one document of each."""
    reps = (named.join(wanted, "name", "left_semi").groupBy("name").agg(F.min("doc").alias("doc"))
            .select(F.col("doc").alias("id")).distinct())

    def made(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = shingle_sets(b["t"].tolist(), n)
            yield pd.DataFrame({"name": [set_name(s) for s in sets], "data": [s.tobytes() for s in sets]})

    chosen = docs.alias("d").join(reps.alias("r"), F.col("d.id").eqNullSafe(F.col("r.id")), "left_semi")
    sets = chosen.select("t").mapInPandas(made, "name bigint, data binary")
    return materialise(sets.groupBy("name").agg(F.first("data").alias("data")), "ngram-sets")


def join_components(docs: DataFrame, n: int = N, similarity: int = SIMILARITY, doc_id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, text_key, group), a row for each document.

    ``text_key`` is a hash of the text, ``group`` names the component (null without words): for joins back
    to documents whose ids repeat.
    """
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("t"),
                       F.xxhash64(text).alias("key"))
    found = _buckets(docs, n, similarity)
    named = found.where("kind = 0").select("doc", "name", "n", "key", "sketch")
    buckets = materialise(found.where("kind = 1").select("bucket", "head", "members").distinct(), "ngram-members")
    placed = buckets.select("bucket", "head", F.explode("members").alias("name"))
    # First: each class with the smallest class that it meets.
    first = placed.groupBy("name").agg(F.min("head").alias("b")).select(F.col("name").alias("a"), "b").where("a <> b")
    sized = materialise(named.join(placed.select("name").distinct(), "name", "left_semi").groupBy("name")
                        .agg(F.max("n").alias("n"), F.first("sketch").alias("sketch")), "ngram-sized")
    first = _likely(first, sized, similarity, "ngram-first")
    links = _verified(first, docs, named, n, similarity, "ngram-links-1")
    parts = materialise(connected_components(links, "ngram-1"), "ngram-parts-1")
    # Then: pairs across components, in buckets that hold several; few of a class while they bring links, then all.
    tried, few, k = first, FEW, 1
    while True:
        parted = sized.join(parts.withColumnRenamed("node", "name"), "name", "left").select(
            "name", "n", "sketch", F.coalesce("component", "name").alias("part"))
        across = _across(placed.select("bucket", "name").join(parted, "name"), similarity, f"ngram-across-{k}", few)
        k += 1
        fresh = _verified(across.join(tried, ["a", "b"], "left_anti"), docs, named, n, similarity, f"ngram-links-{k}")
        none = fresh.isEmpty()
        if not none:
            links = links.union(fresh)
            parts = materialise(connected_components(links, f"ngram-{k}"), f"ngram-parts-{k}")
        if few is None:
            break
        tried = tried.union(across)
        if none or k > ROUNDS:
            few = None
    classes = (named.where("n > 0").groupBy("name").agg(F.min("doc").alias("low"))
               .join(parts.withColumnRenamed("node", "name"), "name", "left")
               .withColumn("component", F.coalesce("component", "name")))
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = classes.join(lowest, "component").select("name", "component", "component_id")
    linked = named.where("n > 0").join(of_class, "name")
    bare = named.where("n = 0").withColumn("component", F.lit(None).cast("bigint")).withColumn("component_id", F.col("doc"))
    return linked.unionByName(bare).select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
                                           F.col("key").alias("text_key"), F.col("component").alias("group"))
