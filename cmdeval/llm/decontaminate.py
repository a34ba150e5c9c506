"""Operator 11: passages of a benchmark in documents, by Wu-Manber multi-pattern search.

Words are runs of ASCII letters (capitals made small), digits and characters from
U+0080 up. A test string is a window of ``n`` consecutive words of a benchmark
item, or all words of a shorter item. Texts and windows are brought to one form,
their words each between single blanks, as UTF-8; a window then occurs at a word
boundary exactly where its bytes do.

The search. Windows of like byte length share a table. With ``m`` the least
length in a table (``MAX_PREFIX`` at most) and blocks of up to eight bytes, the
shift table tells for a hash of a block how near the end of some window's first
``m`` bytes it stands: a text position may move on by that much unread. Where the
shift is 0, the hash of that suffix block with the block at the window's start
selects a bucket of windows, and comparing bytes confirms an occurrence. Many
stretches of text are searched side by side, a step of all at a time.

Scale. Documents are never shuffled. The benchmark is the stated query set: its
distinct (window, item) pairs are dealt by hash into blocks of about
``BLOCK_PAIRS`` pairs and ``BLOCK_BYTES`` bytes, and the documents pass one block
after another, each of bounded size as a broadcast. Texts are searched in groups
of ``GROUP_BYTES``, or one text where it alone is longer.

Null and empty texts have no words. Items without words match nothing. Items that
repeat an id count as one; a null item id can't be named: its passages are hit, but
it isn't listed. Rows that repeat stay rows of their own. Empty tables give an empty
result, or documents without hits. Columns of the documents named like a result
column are replaced, all others stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialise, ship

WINDOW = 10
MAX_PREFIX = 128
BLOCK_PAIRS = 1 << 17
BLOCK_BYTES = 32 << 20
GROUP_BYTES = 4 << 20
#: Bytes of text that one of the side-by-side searches covers.
STRETCH = 1024

#: Capitals to small letters, what is in no word to a blank.
_FORM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
              for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)

RESULT = {"n_words": T.LongType(),
          "spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
          "items": T.ArrayType(T.StringType())}


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FORM).split() if text else []


def windows_of(words: list[bytes], n: int) -> set[bytes]:
    if not words:
        return set()
    width = min(n, len(words))
    return {b" " + b" ".join(words[i:i + width]) + b" " for i in range(len(words) - width + 1)}


class WindowTable:
    """Shift table and buckets of windows whose lengths lie within a factor of two."""

    def __init__(self, windows: list[bytes], numbers: list[int]):
        self.m = min(min(map(len, windows)), MAX_PREFIX)
        self.block = min(8, max(3, self.m // 2))
        self.mask = np.uint64((1 << 8 * self.block) - 1)
        reach = self.m - self.block
        heads = np.frombuffer(b"".join(w[:self.m] + bytes(8) for w in windows), np.uint8).reshape(len(windows), self.m + 8)
        bits = min(24, max(10, math.ceil(math.log2(4 * len(windows) * (reach + 1)))))
        self.down = np.uint64(64 - bits)
        self.shift = np.full(1 << bits, reach + 1, dtype=np.uint8)
        for j in range(reach + 1):  # later blocks stand nearer the end: they overwrite
            self.shift[self.slot(self._blocks(heads, j))] = reach - j
        key = self.key(self._blocks(heads, 0), self._blocks(heads, reach))
        order = np.argsort(key, kind="stable")
        self.keys, first = np.unique(key[order], return_index=True)
        self.edges = np.append(first, len(windows))
        self.windows = [windows[i] for i in order]
        self.numbers = np.array(numbers, dtype=np.int64)[order]

    def _blocks(self, heads: np.ndarray, j: int) -> np.ndarray:
        return np.ascontiguousarray(heads[:, j:j + 8]).view("<u8").ravel() & self.mask

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * _MIX) >> self.down

    def key(self, prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
        return (prefix * _MIX) ^ ((suffix * _MIX) >> np.uint64(7)) ^ suffix

    def candidates(self, text: np.ndarray, last: int) -> np.ndarray:
        """Positions up to ``last`` at whose suffix block the shift is 0."""
        at = np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,))
        reach = self.m - self.block
        pos = np.arange(0, last + 1, STRETCH)
        end = np.minimum(pos + STRETCH, last + 1)
        found = []
        while len(pos):
            step = self.shift[self.slot(at[pos + reach] & self.mask)]
            here = step == 0
            if here.any():
                found.append(pos[here])
            pos = pos + np.maximum(step, 1)
            on = pos < end
            pos, end = pos[on], end[on]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def search(self, text: np.ndarray, data: bytes, n: int) -> Iterator[tuple[int, int]]:
        """(position, window number) of all occurrences in the first ``n`` bytes."""
        if n < self.m:
            return
        pos = self.candidates(text, n - self.m)
        if not len(pos):
            return
        at = np.ndarray(len(text) - 7, dtype="<u8", buffer=text, strides=(1,))
        key = self.key(at[pos] & self.mask, at[pos + (self.m - self.block)] & self.mask)
        bucket = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        met = self.keys[bucket] == key
        for p, b in zip(pos[met].tolist(), bucket[met].tolist()):
            for i in range(self.edges[b], self.edges[b + 1]):
                if data.startswith(self.windows[i], p):
                    yield p, int(self.numbers[i])


class Block:
    """The tables of one block of windows and the items that hold each window."""

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        held: dict[bytes, list[str]] = {}
        for window, item in pairs:
            held.setdefault(window, [])
            if item is not None:
                held[window].append(item)
        windows = list(held)
        self.items = list(held.values())
        self.words = np.array([w.count(b" ") - 1 for w in windows], dtype=np.int64)
        kinds: dict[int, list[int]] = {}
        for i, w in enumerate(windows):
            kinds.setdefault(min(int(math.log2(len(w) / 3)), 5), []).append(i)
        self.tables = [WindowTable([windows[i] for i in of], of) for of in kinds.values()]

    def search(self, texts: list[bytes | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """For each text its number of words, the word ranges inside occurrences, and the items that occur."""
        formed = [words_of(t) for t in texts]
        data = b"\0".join(b" " + b" ".join(w) + b" " for w in formed)
        n = len(data)
        text = np.frombuffer(data + bytes(8), np.uint8)
        hits = [h for table in self.tables for h in table.search(text, data, n)]
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        items: list[set[str]] = [set() for _ in texts]
        if hits:
            pos, which = np.array(hits, dtype=np.int64).T
            blanks = np.flatnonzero(text[:n] == 32)
            # A text of k words has k + 1 blanks (2 if k is 0), each before a word but for the last.
            base = np.concatenate([[0], np.cumsum([max(len(w), 1) + 1 for w in formed])])
            start = np.searchsorted(blanks, pos)
            edge = np.zeros(len(blanks) + 1, dtype=np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + self.words[which], -1)
            inside = np.concatenate([[0], np.cumsum(edge) > 0, [0]]).astype(np.int8)
            turns = np.diff(inside)
            lo, hi = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
            owner = np.searchsorted(base, lo, side="right") - 1
            for d, a, b in zip(owner.tolist(), (lo - base[owner]).tolist(), (hi - base[owner]).tolist()):
                spans[d].append((a, b))
            doc = np.searchsorted(base, start, side="right") - 1
            for d, w in set(zip(doc.tolist(), which.tolist())):
                items[d].update(self.items[w])
        return [(len(w), s, i) for w, s, i in zip(formed, spans, items)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(window, item): the distinct windows of each item."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                found = list(windows_of(words_of(t), n))
                for lo in range(0, len(found), 10_000):
                    part = found[lo:lo + 10_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([item] * len(part), pa.string())],
                                                     ["window", "item"])

    rows = benchmark.select(F.col(item_id).cast("string"), F.col(text).cast("string"))
    return rows.mapInArrow(cut, "window binary, item string").distinct()


def find_passages(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, doc_text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``docs`` with n_words, spans (merged word ranges that benchmark windows cover, from 0, end exclusive)
    and items (sorted ids of the items whose windows occur)."""
    spark = docs.sparkSession
    ship(spark)
    pairs = materialise(benchmark_windows(benchmark, n, item_id, item_text), "bench-windows")
    size = pairs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("window")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_pairs), -(-(size["bytes"] or 0) // BLOCK_BYTES))
    kept = [c for c in docs.columns if c.lower() not in RESULT]
    found, place = docs.select(*kept), kept.index(doc_text)
    schema = T.StructType([*found.schema.fields, *[T.StructField(c, t) for c, t in RESULT.items()]])
    arrow = {"n_words": pa.int64(), "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
             "items": pa.list_(pa.string())}

    def searched(table, again: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = table.value
            for batch in batches:
                texts = batch.column(place).cast(pa.binary())
                lo = 0
                while lo < len(texts):
                    group, held = [], 0
                    while lo + len(group) < len(texts) and held < GROUP_BYTES:
                        group.append(texts[lo + len(group)].as_py())
                        held += len(group[-1] or b"")
                    part = batch.slice(lo, len(group))
                    rows = block.search(group)
                    if again:
                        before = zip(part.column(len(kept) + 1).to_pylist(), part.column(len(kept) + 2).to_pylist())
                        rows = [(k, merged(s + [(x["start"], x["end"]) for x in s0]), i | set(i0))
                                for (k, s, i), (s0, i0) in zip(rows, before)]
                    made = [[k for k, _, _ in rows], [[{"start": a, "end": b} for a, b in s] for _, s, _ in rows],
                            [sorted(i) for _, _, i in rows]]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:len(kept)], *[pa.array(v, arrow[c]) for c, v in zip(RESULT, made)]], schema.names)
                    lo += len(group)
        return run

    for k in range(blocks):
        of = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == k)
        rows = of.toArrow()
        block = Block(list(zip(rows.column("window").to_pylist(), rows.column("item").to_pylist())))
        found = found.mapInArrow(searched(spark.sparkContext.broadcast(block), k > 0), schema)
        if k < blocks - 1:
            found = materialise(found, "bench-searched")
    return found
