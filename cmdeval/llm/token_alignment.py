"""Operator 13: links between the tokens of two tokenizers, by token-byte incidence matrices.

A text, with a blank before it, is encoded by a byte-level tokenizer (A) and by a
piece tokenizer (B). Each token is a row of a matrix with an entry for each byte
that it covers, held in compressed rows (CSR) built here. Gustavson's row products
of A with the transpose of B hold the bytes that an A and a B token share: their
entries are the overlap links. Where tokens of both end, the bytes are cut into
groups; the product of the group incidences (A tokens by groups, groups by B
tokens) holds the links by shared group, of which each row is one run of B tokens.

Both tokenizers end a token before a blank that stands alone between other
characters. So the matrices fall into blocks, one for each stretch of text between
such blanks, and equal stretches have equal blocks: a worker makes the products of
many new stretches at once, remembers them (``CACHE_IDS`` ids at most), and a
document is a sequence of stretch numbers.

Counts over the corpus. Documents pass in groups of ``GROUP_CHARS`` characters. A
group gives its distinct pairs with their number of links, already summed; these are
summed over all groups, the highest count of each B id is taken, and the counts go
back to the groups by a join on the pair: no task holds a table of all pairs. A pair
meets at most one row of each group, so a frequent pair is as many rows as there
are groups, not as there are links.

Texts that are null or empty, or whose tokens' bytes, joined, are not those of the
blank and the text (a text with U+2581, say), have no tokens. Repeated rows and ids
stay rows of their own and all count. An empty table gives an empty result. Other
columns play no part.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_count import tokenizer_path
from .common import materialise, ship

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
GROUP_CHARS = 4 << 20
CACHE_IDS = 1 << 20
#: Characters of new stretches that go to the tokenizers in one call.
CALL_CHARS = 1 << 14
MARK = "▁"

_ALONE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s | \s|^ | $")
_BYTE = re.compile(r"<0x([0-9A-F]{2})>")


def csr_of(owner: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Compressed rows of the matrix with one entry a row, in column ``owner`` of that row."""
    if len(owner) and owner.max() >= columns:
        raise ValueError("column out of range")
    return np.arange(len(owner) + 1), owner


def transposed(ptr: np.ndarray, idx: np.ndarray, columns: int) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    order = np.argsort(idx, kind="stable")
    return np.concatenate([[0], np.cumsum(np.bincount(idx, minlength=columns))]), rows[order]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i] + sizes[i] - 1`` of each i, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def row_products(ptr_a, idx_a, ptr_b, idx_b, columns: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ptr, idx, values) of the product of two 0/1 matrices: row i gathers the rows of the second that row i of
    the first names, and entries of one column are added up."""
    sizes = (ptr_b[1:] - ptr_b[:-1])[idx_a]
    col = idx_b[spread(ptr_b[idx_a], sizes)]
    row = np.repeat(np.repeat(np.arange(len(ptr_a) - 1), np.diff(ptr_a)), sizes)
    key = row * columns + col
    if len(key) and np.any(key[1:] < key[:-1]):
        key = np.sort(key)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, dtype=np.int64)
    values = np.diff(np.append(first, len(key)))
    row, col = key[first] // columns, key[first] % columns
    return np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(ptr_a) - 1))]), col, values


def incidence(ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token-byte matrix of tokens that end at these byte offsets."""
    return np.concatenate([[0], ends]), np.arange(ends[-1] if len(ends) else 0)


def byte_level() -> dict[str, int]:
    """Characters of a byte-level vocabulary: printable Latin-1 stands for itself, the other bytes count up from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Numbers(dict):
    """Stretch -> its number in the order of first meeting; ``new`` lists those just met."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, text: str) -> int:
        self.new.append(text)
        i = self[text] = len(self)
        return i


class Ragged:
    """Growing rows of numbers."""

    def __init__(self, dtype=np.int64):
        self.flat, self.ptr = np.zeros(1 << 12, dtype=dtype), np.zeros(1 << 10, dtype=np.int64)
        self.rows = 0

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        n, rows = int(self.ptr[self.rows]), self.rows + len(sizes)
        while len(self.flat) < n + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.ptr) <= rows:
            self.ptr = np.concatenate([self.ptr, np.zeros_like(self.ptr)])
        self.flat[n:n + len(flat)] = flat
        self.ptr[self.rows + 1:rows + 1] = n + np.cumsum(sizes)
        self.rows = rows

    def sizes(self, rows: np.ndarray) -> np.ndarray:
        return self.ptr[rows + 1] - self.ptr[rows]

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The rows named, one after another."""
        return self.flat[spread(self.ptr[rows], self.sizes(rows))]


class Aligner:
    """Both tokenizers, and the blocks of the stretches met."""

    def __init__(self, a_path: str, b_path: str, with_places: bool = False):
        self.with_places = with_places
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = byte_level()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        a_bytes = [t.encode() if i in special else bytes(chars[c] for c in t) for i, t in enumerate(entries)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces]
        self.b_size = len(pieces)
        self.bytes = [np.array([*x, None], dtype=object)[:-1] for x in (a_bytes, b_bytes)]
        self.lengths = [np.array([len(t) for t in x], dtype=np.int64) for x in (a_bytes, b_bytes)]
        # Texts of ids: after A ids a comma or, at a group's end, a bar; after B ids a comma or a semicolon.
        self.names = [np.array([f"{i}{s}" for s in (",", last) for i in range(len(x))], dtype=object)
                      for x, last in ((a_bytes, "|"), (b_bytes, ";"))]
        self.reset()

    def reset(self) -> None:
        self.known = Numbers()
        self.ids = [Ragged(np.int32), Ragged(np.int32)]
        self.links = Ragged()  # a pair of ids for each link
        self.places = Ragged(np.int32)  # the same links as places of tokens and bytes shared, where asked for
        self.groups = Ragged(np.int32)  # for each group of a stretch the places at which its A and B tokens end
        self.shared = Ragged()  # the number of links by shared group, a row a stretch
        self.texts: list[str] = []
        self.faithful: list[bool] = []

    def stretches(self, text: str) -> list[str]:
        """The text between its lone blanks."""
        return _ALONE.split(text) if _ODD.search(text) else text.split(" ")

    def numbers(self, text: str | None) -> np.ndarray | None:
        """Stretch numbers of a text; null where it has no tokens."""
        if not text or MARK in text:
            return None
        parts = self.stretches(text)
        return np.fromiter(map(self.known.__getitem__, parts), dtype=np.int64, count=len(parts))

    def learn(self) -> None:
        """Blocks of the stretches that ``numbers`` met first."""
        new, self.known.new = self.known.new, []
        lo = 0
        while lo < len(new):
            hi, chars = lo, 0
            while hi < len(new) and chars < CALL_CHARS:
                chars += len(new[hi]) + 1
                hi += 1
            if not self._learn(new[lo:hi]):
                for part in new[lo:hi]:  # one of them isn't given back by its tokens
                    if not self._learn([part]):
                        self._unfaithful()
            lo = hi

    def _unfaithful(self) -> None:
        none, zero = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        for table in (*self.ids, self.links, self.places, self.groups, self.shared):
            table.add(none, zero)
        self.texts.append("")
        self.faithful.append(False)

    def _learn(self, parts: list[str]) -> bool:
        joined = " ".join(parts)
        ids = [np.array(self.a.encode(" " + joined, add_special_tokens=False).ids, dtype=np.int64),
               np.array(self.b.encode(joined, num_threads=1), dtype=np.int64)]
        whole = (" " + joined).encode("utf-8", "surrogatepass")
        if any(b"".join(table[i].tolist()) != whole for table, i in zip(self.bytes, ids)):
            return False
        ends = [np.cumsum(n[i]) for n, i in zip(self.lengths, ids)]
        stop = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        ptr = [np.concatenate([[0], np.searchsorted(e, stop) + 1]) for e in ends]
        if any(np.any(e[p[1:] - 1] != stop) for e, p in zip(ends, ptr)):
            return False  # a token across a blank
        # Overlap links: token-byte rows of A times byte-token rows of B.
        n_bytes = len(whole)
        b_ptr, b_idx = transposed(*incidence(ends[1]), n_bytes)
        c_ptr, c_idx, c_val = row_products(*incidence(ends[0]), b_ptr, b_idx, len(ids[1]))
        c_row = np.repeat(np.arange(len(ids[0])), np.diff(c_ptr))
        per_part = np.diff(c_ptr[ptr[0]])
        self.links.add(ids[0][c_row] * self.b_size + ids[1][c_idx], per_part)
        if self.with_places:
            owner = np.repeat(np.arange(len(parts)), per_part)
            self.places.add(np.stack([c_row - ptr[0][owner], c_idx - ptr[1][owner], c_val], axis=1).ravel(), 3 * per_part)
        # Groups, and the sizes of the rows of the product of their incidences.
        cuts = np.intersect1d(ends[0], ends[1], assume_unique=True)
        group = [np.searchsorted(cuts, e) for e in ends]
        held = [np.bincount(g, minlength=len(cuts)) for g in group]
        g_ptr, _ = transposed(*csr_of(group[1], len(cuts)), len(cuts))
        per_row = np.concatenate([[0], np.cumsum(np.diff(g_ptr)[group[0]])])
        self.shared.add(np.diff(per_row[ptr[0]]), np.ones(len(parts), dtype=np.int64))
        of_part = np.diff(np.concatenate([[0], np.searchsorted(cuts, stop) + 1]))
        after = [np.cumsum(h) for h in held]
        in_part = np.repeat(np.arange(len(parts)), of_part)
        self.groups.add(np.stack([a - p[in_part] for a, p in zip(after, ptr)], axis=1).ravel(), 2 * of_part)
        for table, i, p in zip(self.ids, ids, ptr):
            table.add(i, np.diff(p))
        # Texts of the groups: A ids, then B ids of each.
        row = np.empty(len(ids[0]) + len(ids[1]), dtype=object)
        place = [np.arange(len(ids[0])) + (after[1] - held[1])[group[0]], np.arange(len(ids[1])) + after[0][group[1]]]
        for side in (0, 1):
            last = np.concatenate([group[side][1:] != group[side][:-1], [True]])
            row[place[side]] = self.names[side][ids[side] + last * len(self.lengths[side])]
        row, at = row.tolist(), (ptr[0] + ptr[1]).tolist()
        self.texts += ["".join(row[lo:hi])[:-1] for lo, hi in zip(at, at[1:])]
        self.faithful += [True] * len(parts)
        return True


_ALIGNERS: dict[tuple[str, str, bool], Aligner] = {}


def aligner_at(a_file: str, b_file: str, with_places: bool = False) -> Aligner:
    key = (tokenizer_path(a_file), tokenizer_path(b_file), with_places)
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def _groups(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of groups of at most ``GROUP_CHARS`` characters, or one text."""
    texts, lo = batch.column(at), 0
    while lo < len(texts):
        group, chars = [], 0
        while lo + len(group) < len(texts) and chars < GROUP_CHARS:
            group.append(texts[lo + len(group)].as_py())
            chars += len(group[-1] or "")
        yield lo, group
        lo += len(group)


def _met(al: Aligner, texts: list[str | None]) -> list[np.ndarray | None]:
    """Stretch numbers of each text; null where it has no tokens."""
    if al.ids[0].ptr[al.ids[0].rows] > CACHE_IDS:
        al.reset()
    found = [al.numbers(t) for t in texts]
    al.learn()
    bad = {i for i, same in enumerate(al.faithful) if not same} if not all(al.faithful) else set()
    return [None if n is None or (bad and not bad.isdisjoint(n.tolist())) else n for n in found]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2 ** 32, byte by byte of all: high bytes, nearly all 0, pack well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


PART_SCHEMA = ("block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, "
               "groups_sha256 string, stretches binary, sizes binary, links binary, pairs binary, counts binary")


def _parts(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """A row for each document, and for each group of documents one with its stretches, their links and its pairs."""
    names = [x.split(" ")[0] for x in PART_SCHEMA.split(", ")]
    kinds = [{"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split(" ")[1]] for x in PART_SCHEMA.split(", ")]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        al, block = aligner_at(a_file, b_file), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, texts in _groups(batch, 1):
                doc_ids = batch.column(0).slice(lo, len(texts)).to_pylist()
                found = _met(al, texts)
                every = np.concatenate([np.zeros(0, dtype=np.int64), *[n for n in found if n is not None]])
                used, local, times = np.unique(every, return_inverse=True, return_counts=True)
                sizes = al.links.sizes(used)
                pairs, link = np.unique(al.links.of(used), return_inverse=True)
                counts = np.bincount(link, weights=np.repeat(times, sizes), minlength=len(pairs)).astype(np.int64)
                per = [al.ids[0].sizes(used), al.ids[1].sizes(used), al.groups.sizes(used) // 2, sizes, al.shared.of(used)
                       if len(used) else np.zeros(0, dtype=np.int64)]
                rows, at = [], 0
                for doc, n in zip(doc_ids, found):
                    if n is None:
                        rows.append((block, doc, 0, 0, 0, 0, 0, "", b"", None, None, None, None))
                        continue
                    mine = local[at:at + len(n)]
                    at += len(n)
                    text = ";".join(map(al.texts.__getitem__, n.tolist()))
                    rows.append((block, doc, *[int(p[mine].sum()) for p in per], hashlib.sha256(text.encode()).hexdigest(),
                                 _planes(mine), None, None, None, None))
                rows.append((block, *[None] * 8, _planes(sizes), _planes(link), pairs.astype("<i8").tobytes(), counts.astype("<i8").tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                block += 1

    return docs.mapInArrow(aligned, PART_SCHEMA)


def _pair_rows(parts: DataFrame, b_size: int) -> DataFrame:
    """(block, place, pair, n): the distinct pairs of each group of documents."""
    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pairs, counts in zip(*[c.to_pylist() for c in b.columns]):
                pairs, counts = np.frombuffer(pairs, "<i8"), np.frombuffer(counts, "<i8")
                for lo in range(0, len(pairs), 1 << 16):
                    p = pairs[lo:lo + (1 << 16)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(p), block)), pa.array(np.arange(lo, lo + len(p))), pa.array(p // b_size), pa.array(p % b_size),
                         pa.array(counts[lo:lo + (1 << 16)])], ["block", "place", "a_id", "b_id", "n"])

    return (parts.where("pairs IS NOT NULL").select("block", "pairs", "counts")
            .mapInArrow(unpacked, "block bigint, place bigint, a_id bigint, b_id bigint, n bigint"))


def _counted(pair_rows: DataFrame) -> DataFrame:
    counts = pair_rows.groupBy("a_id", "b_id").agg(F.sum("n").alias("n_links"))
    highest = counts.groupBy("b_id").agg(F.max("n_links").alias("highest"))
    return counts.join(highest, "b_id").select("a_id", "b_id", "n_links", (F.col("n_links") == F.col("highest")).alias("best"))


def pair_counts(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(a_id, b_id, n_links, best): the corpus-wide links of each pair of ids, and whether no other A id is
    linked more often with that B id."""
    return _counted(_pair_rows(_made(docs, a_file, b_file, doc_id, text), _b_size(b_file)))


def _b_size(b_file: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b_file)).get_piece_size()


def _made(docs: DataFrame, a_file: str, b_file: str, doc_id: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return materialise(_parts(rows, a_file, b_file), "align-parts")


def align(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups_sha256), a row for each document.

    ``n_shared`` counts the links by shared group. The hash is of the ids of all groups in order, as
    ``a1,a2|b1;a3|b2,b3``.
    """
    parts = _made(docs, a_file, b_file, doc_id, text)
    pair_rows = _pair_rows(parts, _b_size(b_file))
    back = (pair_rows.join(_counted(pair_rows), ["a_id", "b_id"])
            .select("block", "place", "n_links", F.col("best").cast("bigint").alias("best")))

    def summed(rows: pa.Table, known: pa.Table) -> pa.Table:
        docs_, made = rows.filter(pa.compute.is_valid(rows["stretches"])), rows.filter(pa.compute.is_valid(rows["pairs"]))
        place = known["place"].to_numpy()
        table = np.zeros((2, len(place)), dtype=np.int64)
        table[0][place], table[1][place] = known["best"].to_numpy(), known["n_links"].to_numpy()
        sizes, link = _unplaned(made["sizes"][0].as_py()), _unplaned(made["links"][0].as_py())
        ends = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for values in table:
            total = np.concatenate([[0], np.cumsum(values[link])])
            out.append(total[ends[1:]] - total[ends[:-1]])
        sums = [[int(per[_unplaned(s)].sum()) if s else 0 for s in docs_["stretches"].to_pylist()] for per in out]
        kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups_sha256"]
        return pa.table([*[docs_[c] for c in kept], pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64())],
                        names=[*kept, "n_best", "count_sum"])

    return parts.drop("counts").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        summed, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_shared bigint, groups_sha256 string, "
                "n_best bigint, count_sum bigint")


def token_links(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a_ids, b_ids, links, groups): tokens of both, the places of linked tokens with the bytes they share,
    and the places at which the tokens of each group end. Tokens share a group where their places lie in one."""
    ship(docs.sparkSession)
    link = pa.struct([("a", pa.int64()), ("b", pa.int64()), ("bytes", pa.int64())])
    cut = pa.struct([("a_end", pa.int64()), ("b_end", pa.int64())])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner_at(a_file, b_file, with_places=True)
        for batch in batches:
            for lo, texts in _groups(batch, 1):
                rows = []
                for doc, n in zip(batch.column(0).slice(lo, len(texts)).to_pylist(), _met(al, texts)):
                    if n is None:
                        rows.append((doc, [], [], [], []))
                        continue
                    per = [t.sizes(n) for t in al.ids]
                    before = [np.cumsum(p) - p for p in per]
                    of = np.repeat(np.arange(len(n)), al.links.sizes(n))
                    links = al.places.of(n).reshape(-1, 3) + np.stack([before[0][of], before[1][of], 0 * of], axis=1)
                    of = np.repeat(np.arange(len(n)), al.groups.sizes(n) // 2)
                    ends = al.groups.of(n).reshape(-1, 2) + np.stack([before[0][of], before[1][of]], axis=1)
                    rows.append((doc, *[t.of(n).tolist() for t in al.ids], [dict(zip(("a", "b", "bytes"), x)) for x in links.tolist()],
                                 [dict(zip(("a_end", "b_end"), x)) for x in ends.tolist()]))
                kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(link), pa.list_(cut)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 ["doc_id", "a_ids", "b_ids", "links", "groups"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(listed, "doc_id bigint, a_ids array<bigint>, b_ids array<bigint>, "
                                   "links array<struct<a: bigint, b: bigint, bytes: bigint>>, "
                                   "groups array<struct<a_end: bigint, b_end: bigint>>")
