"""Operator 9: SentencePiece encoding and decoding by a max-plus parallel scan.

The model is SentencePiece's BPE kind. A sequence of pieces is the encoding of
its text exactly if no two neighbours would be cut or merged otherwise, that is
if every neighbouring pair is the encoding of the two pieces' own text. So the
encoding is the one path of weight 0 through the lattice of pieces in which a
pair of neighbours weighs 0 if it is such an encoding and minus infinity if not.

Giant documents are split into chunks of ``CHUNK_CHARS`` characters, anywhere.
A state of a boundary is a piece that reaches over or ends at it. Each chunk
alone yields its transfer matrix: the best weight from each state of its left
boundary to each of its right one. Max-plus products are associative: prefix
and suffix products give the state of every boundary, and with its two states
each chunk recovers its own ids, independently of the others. Only matrices of
a few states meet in one place, never the chunks' texts.

Inside a chunk, no piece crosses the place before a run of blanks or beside a
line feed, so the words between two such places are encoded by the library,
each distinct word once for each worker (``CACHE_ENTRIES`` at most).

Decoding joins the pieces' bytes, turns the blank marks into blanks and drops
the first one. A text that holds the blank mark itself decodes to blanks there.

Null text counts as empty; an empty text has no ids. Rows with equal id and
text share one encoding. All columns of the documents pass; ids, n_tokens
and round_trip are replaced where they exist. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_count import tokenizer_path
from .common import apart, materialise, ship

CHUNK_CHARS = 65_536
CACHE_ENTRIES = 200_000
PAIR_ENTRIES = 100_000
GROUP_CHARS = 1 << 20
MARK = "▁"

NEVER = -np.inf
_WORDS = re.compile(" *[^ \n]+| +|\n")
_CUTS = re.compile(f"(?<=[^{MARK}])(?={MARK})|(?<=\n)|(?=\n)")


class Pieces:
    """The model's pieces, word encodings and the weights of neighbours."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        names = [self.library.id_to_piece(i) for i in range(n)]
        special = [self.library.is_unknown(i) or self.library.is_control(i) or self.library.is_byte(i) or
                   self.library.is_unused(i) for i in range(n)]
        self.number = {p: i for i, p in enumerate(names) if not special[i]}
        self.score = {p: self.library.get_score(i) for p, i in self.number.items()}
        self.longest = max(map(len, self.number))
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.number):
            raise ValueError("pieces that hold a blank or line feed inside are not supported")
        self.byte = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not self.library.is_byte(i) for i in self.byte):
            raise ValueError("only models with byte fallback are supported")
        self.bytes_of = [b"" if special[i] else p.encode() for i, p in enumerate(names)]
        for b, i in enumerate(self.byte):
            self.bytes_of[i] = bytes([b])
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reset()

    # Words ------------------------------------------------------------------

    def reset(self) -> None:
        self.words: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.starts, self.sizes = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.n_flat = 0

    def learn(self, words: list[str]) -> None:
        # The library puts a blank before every text but an empty one; what follows a line feed stands as it is.
        led = [w[0] == " " and not w.isspace() for w in words]
        got = self.library.encode([w[1:] if x else "\n" + w for w, x in zip(words, led)], num_threads=1)
        got = [ids if x else ids[2:] for ids, x in zip(got, led)]
        sizes = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        ids = np.fromiter(chain.from_iterable(got), dtype=np.int32, count=int(sizes.sum()))

        def room(a: np.ndarray, n: int) -> np.ndarray:
            return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

        lo, n = len(self.words), len(words)
        self.flat = room(self.flat, self.n_flat + len(ids))
        self.starts, self.sizes = room(self.starts, lo + n), room(self.sizes, lo + n)
        self.flat[self.n_flat:self.n_flat + len(ids)] = ids
        self.sizes[lo:lo + n] = sizes
        self.starts[lo:lo + n] = self.n_flat + np.cumsum(sizes) - sizes
        self.words.update(zip(words, range(lo, lo + n)))
        self.n_flat += len(ids)

    def encode_words(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of lists of words, and the number of ids of each list."""
        if len(self.words) > CACHE_ENTRIES:
            self.reset()
        known = self.words
        if new := {w for words in split for w in words if w not in known}:
            self.learn(list(new))
        counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        words = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=int(counts.sum()))
        sizes = self.sizes[words]
        total = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.starts[words] - total[:-1], sizes) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], np.cumsum(counts)])])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        ids, sizes = self.encode_words([_WORDS.findall(" " + t.replace(MARK, " ")) if t else [] for t in texts])
        return np.split(ids, np.cumsum(sizes)[:-1]) if len(texts) else []

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:]

    # Lattice ----------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text: the best neighbours merge first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def weight(self, left: str, right: str) -> float:
        """0 if the two pieces are the encoding of their text. An empty ``left`` is the start."""
        key = (left, right)
        if key not in self.pairs:
            if len(self.pairs) >= PAIR_ENTRIES:
                self.pairs.clear()
            self.pairs[key] = self.merged(left + right) == [p for p in key if p]
        return 0.0 if self.pairs[key] else NEVER

    def ends(self, text: str, start: int) -> list[int]:
        """Where pieces that start at ``start`` end; a single character always is one."""
        return [e for e in range(start + 1, min(len(text), start + self.longest) + 1)
                if e == start + 1 or text[start:e] in self.number]

    def ids_of(self, piece: str) -> list[int]:
        i = self.number.get(piece)
        return [i] if i is not None else [self.byte[b] for b in piece.encode("utf-8", "replace")]

    def states(self, text: str, boundary: int) -> list[tuple[int, int]]:
        """Pieces that start before a boundary and reach it, as (start, end)."""
        return [(s, e) for s in range(max(0, boundary - self.longest), boundary) for e in self.ends(text, s) if e >= boundary]


class Chunk:
    """A part of a text with its neighbours' nearest characters, blank marks in place."""

    def __init__(self, pieces: Pieces, before: str, body: str, after: str, first: bool, last: bool):
        self.p, self.text = pieces, before + body + after
        self.lo, self.hi = len(before), len(before) + len(body)
        self.enter = [(self.lo, self.lo)] if first else pieces.states(self.text, self.lo)
        self.leave = [(s, e) for s, e in pieces.states(self.text, self.hi) if not last or e == self.hi]
        self.cuts = [m.start() for m in _CUTS.finditer(self.text, self.lo, self.hi)
                     if self.lo < m.start() < self.hi and m.start() >= max(e for _, e in self.enter)]

    def walk(self, sources: dict[tuple[int, int], np.ndarray], stop: int, goal: set | None) -> dict[tuple[int, int], np.ndarray]:
        """Best weights from the sources to the pieces that end at ``stop``, or to the pieces of ``goal``."""
        at: dict[int, dict[tuple[int, int], np.ndarray]] = {}
        for (s, e), v in sources.items():
            at.setdefault(e, {})[s, e] = v
        done = {}
        for place in range(min(at), stop):
            here = at.pop(place, None)
            if not here:
                continue
            for end in self.p.ends(self.text, place):
                if goal is None and end > stop or goal is not None and end >= stop and (place, end) not in goal:
                    continue
                piece = self.text[place:end]
                best = np.max([v + self.p.weight(self.text[s:e], piece) for (s, e), v in here.items()], axis=0)
                if (best > NEVER).any():
                    at.setdefault(end, {})[place, end] = best
                    if end >= stop:
                        done[place, end] = best
        if goal is not None:
            done |= {k: v for k, v in sources.items() if k in goal}
        return done if goal is not None else at.get(stop, {})

    def matrix(self) -> np.ndarray:
        """Transfer matrix: row for each state entered, column for each state left."""
        n = len(self.enter)
        start = {}
        for i, k in enumerate(self.enter):
            row = np.full(n, NEVER)
            row[i] = 0.0
            start[k] = row
        goal = set(self.leave)
        if self.cuts:  # all paths pass the cut: what follows doesn't depend on what was before
            arrived = self.walk(start, self.cuts[0], None)
            best = np.max([*arrived.values(), np.full(n, NEVER)], axis=0)
            out = self.walk({(self.cuts[-1], self.cuts[-1]): np.zeros(1)}, self.hi, goal)
            return np.stack([best + (out[k][0] if k in out else NEVER) for k in self.leave], axis=1)
        out = self.walk(start, self.hi, goal)
        return np.stack([out.get(k, np.full(n, NEVER)) for k in self.leave], axis=1)

    def path(self, source: tuple[int, int], stop: int, goal: tuple[int, int] | None) -> list[str]:
        """Pieces of the one path from a source to ``stop``, or to the piece ``goal``."""
        came: dict[tuple[int, int], tuple[int, int] | None] = {source: None}
        at = {source[1]: [source]}
        if source == goal:
            return []
        for place in range(source[1], stop):
            for k in at.pop(place, []):
                left = self.text[k[0]:k[1]]
                for end in self.p.ends(self.text, place):
                    new = (place, end)
                    if new in came or end > stop and new != goal:
                        continue
                    if self.p.weight(left, self.text[place:end]) == 0.0:
                        came[new] = k
                        at.setdefault(end, []).append(new)
        last = goal if goal is not None else next(iter(at.get(stop, [])), source)
        out = []
        while last != source:
            out.append(self.text[last[0]:last[1]])
            last = came[last]
        return out[::-1]

    def ids(self, entered: int, left: int) -> np.ndarray:
        """Ids of the pieces that start in this chunk, given the states of its boundaries."""
        source, goal = self.enter[entered], self.leave[left]
        if not self.cuts:
            return np.array([i for p in self.path(source, self.hi, goal) for i in self.p.ids_of(p)], dtype=np.int32)
        a, b = self.cuts[0], self.cuts[-1]
        head = [i for p in self.path(source, a, None) for i in self.p.ids_of(p)]
        tail = [i for p in self.path((b, b), self.hi, goal) for i in self.p.ids_of(p)]
        middle = self.p.encode_words([_WORDS.findall(self.text[a:b].replace(MARK, " "))])[0]
        return np.concatenate([np.array(head, dtype=np.int32), middle, np.array(tail, dtype=np.int32)]).astype(np.int32)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None]).max(axis=1)


def prefix_products(mats: list[np.ndarray]) -> list[np.ndarray]:
    """Products of the first 1, 2, ... matrices, pairs first."""
    if len(mats) < 2:
        return list(mats)
    even = prefix_products([times(a, b) for a, b in zip(mats[::2], mats[1::2])])
    out = [mats[0]]
    for i in range(1, len(mats)):
        out.append(even[i // 2] if i % 2 else times(even[i // 2 - 1], mats[i]))
    return out


def boundary_states(mats: list[np.ndarray]) -> list[int]:
    """The state that the best path has at each right boundary."""
    before = prefix_products(mats)
    after = [m.T for m in prefix_products([m.T for m in reversed(mats)])][::-1]  # of chunk i and all that follow
    if not np.isfinite(before[-1].max()):
        raise ValueError("no path through the chunks")
    return [int((before[i].max(axis=0) + (after[i + 1].max(axis=1) if i + 1 < len(mats) else 0)).argmax())
            for i in range(len(mats))]


_PIECES: dict[str, Pieces] = {}


def pieces_at(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def _chunk(p: Pieces, row) -> Chunk:
    marked = [x.replace(" ", MARK) for x in (row.before, row.body, row.after)]
    if row.chunk == 0:
        marked[1] = MARK + marked[1]
    return Chunk(p, *marked, row.chunk == 0, bool(row.last))


def encode(docs: DataFrame, model: str = "piece_bpe_32k.model", doc_id: str = "doc_id", text: str = "text",
           chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``docs`` with ids (array of int), n_tokens and round_trip: whether decoding the ids gives the text back.

    The worker that encodes a document also decodes it, so ids aren't sent to a second one.
    """
    ship(docs.sparkSession)
    columns, (docs, back) = docs.columns, apart(docs, "_doc", "_key", "_ids", "_k", "_decoded")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces_at(tokenizer_path(model))
        for batch in batches:
            texts, lo = batch.column(place), 0
            while lo < len(texts):
                group, chars = [], 0
                while lo + len(group) < len(texts) and chars < GROUP_CHARS:
                    group.append(texts[lo + len(group)].as_py() or "")
                    chars += len(group[-1])
                ids = p.encode(group)
                same = [p.decode(x.tolist()) == t for x, t in zip(ids, group)]
                sizes = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                flat = np.concatenate([np.zeros(0, dtype=np.int32), *ids]).astype(np.int32)
                made = [pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, len(group)).columns, *made], names)
                lo += len(group)

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces_at(tokenizer_path(model))
        for b in batches:
            mats = [_chunk(p, r).matrix() for r in b.itertuples()]
            yield pd.DataFrame({"doc": b["doc"], "key": b["key"], "chunk": b["chunk"], "rows": [m.shape[0] for m in mats],
                                "matrix": [m.astype("<f8").tobytes() for m in mats]})

    def scan(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        states = boundary_states([np.frombuffer(m, "<f8").reshape(r, -1) for m, r in zip(group["matrix"], group["rows"])])
        return pd.DataFrame({"doc": group["doc"], "key": group["key"], "chunk": group["chunk"],
                             "entered": [0, *states[:-1]], "left": states})

    def backtrace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = pieces_at(tokenizer_path(model))
        for b in batches:
            yield pd.DataFrame({"doc": b["doc"], "key": b["key"], "chunk": b["chunk"],
                                "ids": [_chunk(p, r).ids(r.entered, r.left) for r in b.itertuples()]})

    # Other documents are one chunk: they go to the library word by word, without a shuffle.
    giant = F.coalesce(F.length(text) > chunk_chars, F.lit(False))
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("ids", "round_trip", "n_tokens")]
    names, place = [*[f.name for f in kept], "ids", "round_trip"], [f.name for f in kept].index(text)
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    small = docs.where(~giant).select(*[f.name for f in kept]).mapInArrow(whole, schema)
    margin = pieces_margin(model)
    if chunk_chars < margin:
        raise ValueError(f"chunk_chars must be at least {margin}, the length of the longest piece")
    parts = F.regexp_extract_all(F.col("t"), F.lit(f"((?s).{{1,{chunk_chars}}})"))
    giants = (docs.where(giant).select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("key"), F.col(text).alias("t")))
    chunks = (giants.groupBy("doc", "key").agg(F.min("t").alias("t"))
              .select("doc", "key", parts.alias("parts"))
              .select("doc", "key", F.transform("parts", lambda x, i: F.struct(
                  i.alias("chunk"), x.alias("body"),
                  F.when(i > 0, F.right(F.get("parts", i - 1), F.lit(margin))).otherwise("").alias("before"),
                  F.coalesce(F.left(F.get("parts", i + 1), F.lit(margin)), F.lit("")).alias("after"),
                  (i == F.size("parts") - 1).alias("last"))).alias("parts"))
              .select("doc", "key", F.explode("parts").alias("c")).select("doc", "key", "c.*"))
    chunks = materialise(chunks.repartition("doc", "key", "chunk"), "scan-chunks")
    scanned = (chunks.mapInPandas(matrices, "doc bigint, key bigint, chunk int, rows int, matrix binary")
               .groupBy("doc", "key").applyInPandas(scan, "doc bigint, key bigint, chunk int, entered int, left int"))
    on = F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.chunk") == F.col("b.chunk"))
    traced = (chunks.alias("a").join(scanned.alias("b"), on).select("a.*", "b.entered", "b.left")
              .mapInPandas(backtrace, "doc bigint, key bigint, chunk int, ids array<int>"))
    joined = (traced.groupBy(F.col("doc").alias("_doc"), F.col("key").alias("_key"))
              .agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"])).alias("_ids")))
    large = (docs.where(giant).withColumn("_k", F.xxhash64(text))
             .join(joined, F.col(doc_id).eqNullSafe(F.col("_doc")) & (F.col("_k") == F.col("_key")))
             .withColumn("ids", F.col("_ids")).drop("_doc", "_key", "_ids", "_k"))
    large = decode(large, model, text="_decoded").withColumn("round_trip", F.col("_decoded") == F.col(text)).drop("_decoded")
    out = small.unionByName(large.select(*names)).withColumn("n_tokens", F.size("ids").cast("bigint")).withColumnsRenamed(back)
    # The columns of the documents stand where they stood, those that are new after them.
    made = ["ids", "round_trip", "n_tokens"]
    old = {c.lower(): c for c in columns}
    return out.select(*[c if c.lower() not in made else F.col(c.lower()).alias(c) for c in columns], *[c for c in made if c not in old])


def pieces_margin(model: str) -> int:
    """Characters beyond a boundary that a piece can reach."""
    return pieces_at(tokenizer_path(model)).longest


def decode(encoded: DataFrame, model: str = "piece_bpe_32k.model", ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; null ids give null."""
    ship(encoded.sparkSession)

    @F.pandas_udf("string")
    def back(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        p = pieces_at(tokenizer_path(model))
        for column in batches:
            yield pd.Series([None if x is None else p.decode(x.tolist()) for x in column], dtype=object)

    return encoded.withColumn(text, back(F.col(ids)))
