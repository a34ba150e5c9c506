"""Operator 3: token ids in a binary, grammar-compressed, randomly readable form.

Every text is encoded, an end id follows each document, and the ids of all
documents in ascending ``doc_id`` order are cut into shards of about
``SHARD_TOKENS`` ids at document ends. Each shard is compressed by Re-Pair:
frequent adjacent pairs are replaced by new symbols (nonterminals), again and
again, until no pair occurs ``MIN_COUNT`` times. A round counts pairs exactly
and replaces all that are frequent, a more frequent one before a rarer one where
two overlap, so a shard needs some vectorised rounds instead of one pass for
each rule.

File format: a Parquet table with a row for each shard, written by Spark to a
folder that it can read anywhere:

=============  =========================================================
part, shard    place of the shard: range of ids, number inside the range
part_start     ids before the shard inside its range
n_tokens       ids in the shard
first_rule     symbols below it are token ids
rules          little-endian uint32 pairs: rule r is symbol first_rule + r
lengths        little-endian uint32: expansion length of each rule
symbols        little-endian uint32: the compressed sequence
doc_ids        ids of the documents, in order
doc_tokens     ids of each document, end id included
=============  =========================================================

``decode_slice`` reads any stretch of a shard without expanding the rest: the
cumulated expansion lengths lead to the symbols that cover it. Rules whose use
falls under two are kept; they cost eight bytes.

Null text counts as empty (the end id alone). Rows that repeat a ``doc_id``
each keep their own place, ordered by text; a null ``doc_id`` sorts first.
An empty table gives an empty table. Other columns play no part.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized, normalize

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .bpe_count import tokenizer_path
from .common import ship

SHARD_TOKENS = 1 << 20
#: A pair is replaced while it occurs at least so often in a shard.
MIN_COUNT = 24
SLOT_MASK = (1 << 19) - 1
CACHE_ENTRIES = 1_300_000
GROUP_CHARS = 1 << 20
#: A digit is a token of its own: it parts the words of one call to the library.
SEPARATOR = "0"

#: Characters that are no punctuation, or full stop and comma.
_COMMON = frozenset(string.ascii_letters + string.digits + " \t\r\n.," + "".join(
    c for c in map(chr, range(0xC0, 0x250)) if c.isalpha() and len(c.lower()) == 1))

SHARD_SCHEMA = ("part int, shard int, part_start bigint, n_tokens bigint, first_rule bigint, rules binary, "
                "lengths binary, symbols binary, doc_ids array<bigint>, doc_tokens array<bigint>")

#: Characters that nothing composes with or takes apart: ASCII and letters of some scripts.
_STABLE = frozenset([*map(chr, range(0x80)), *(c for c in map(chr, range(0xC0, 0x530)) if c.isalpha()
                                               and len(c.lower()) == 1 and is_normalized("NFC", c))])
#: What the tokenizer's pattern takes a byte of such a text for.
_SPACE, _LETTER, _DIGIT, _MARK = range(4)
_KINDS = np.full(256, _MARK, dtype=np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_KINDS[[*string.ascii_letters.encode(), *range(0x80, 0x100)]] = _LETTER
_KINDS[[*string.digits.encode()]] = _DIGIT

_ODD_SPACE = re.compile("[\x1c-\x1f]")
_WORDS = re.compile("[^ \n\t\r]+")
#: Full stops or commas beside what the tokenizer's pattern takes for punctuation: the four separators, white space to
#: Python, are that too.
_RUNS = re.compile(r"[.,](?:[^\w\s]|[_\x1c-\x1f])|(?:[^\w\s]|[_\x1c-\x1f])[.,]")


def _shaped(text: str, odd: set[str]) -> str:
    """The text as the tokenizer's pattern sees it, where a character of it could come apart into a letter and a mark."""
    apart = any(len(c.lower()) > 1 or not is_normalized("NFC", c) for c in odd)
    return normalize("NFC", text).lower() if apart else text


class Numbers(dict):
    """Word -> its number, from 1 in the order of first meeting; ``new`` lists those just met."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        i = self[word] = len(self) + 1
        return i


class WordEncoder:
    """Ids of texts by way of their white-space-free words.

    The tokenizer drops white space, so no token crosses it: each distinct word
    is encoded by the library once and remembered (``CACHE_ENTRIES`` at most).
    ASCII capitals become small, as the tokenizer makes them. Texts of stable
    characters are cut at once where letters, digits, punctuation and white space
    meet, as its pattern has them; in others, full stops and commas that touch no
    other punctuation stand alone.
    """

    def __init__(self, path: str, end_id: int):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # For words that the normaliser and the pattern leave as they are.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.end_id = end_id
        self.separator = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids[0]
        self.reset()

    def reset(self) -> None:
        self.known = Numbers()
        self.flat = np.full(1 << 16, self.end_id, dtype=np.uint32)  # word 0 is the end of a document
        self.starts, self.sizes = np.zeros(1 << 14, dtype=np.int64), np.zeros(1 << 14, dtype=np.int64)
        self.sizes[0], self.n_words, self.n_flat = 1, 1, 1

    def split(self, text: str) -> list[str]:
        odd = set(text) - _COMMON
        # No special token may come to be, and no run of punctuation may be cut.
        if "<" not in odd and not any(x in text for x in ("..", ".,", ",.", ",,")) and not (
                odd and _RUNS.search(_shaped(text, odd))):
            text = text.encode("utf-8", "replace").lower().decode().replace(".", " . ").replace(",", " , ")
        return _WORDS.findall(text) if odd and _ODD_SPACE.search(text) else text.split()

    def learn(self, words: list[str]) -> None:
        """Give new words, numbered in this order, their ids."""
        easy = [w.isalpha() and w == w.lower() and (w.isascii() or is_normalized("NFC", w)) for w in words]
        plain = [w for w, x in zip(words, easy) if x]
        # Plain words go many to a call, parted by a word whose only id no other of them has.
        between = f" {SEPARATOR} "
        groups = [plain[lo:lo + 256] for lo in range(0, len(plain), 256)]
        found = self.plain.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False)
        ids = [np.array(x, dtype=np.uint32) for e in found for x in (e.ids, [self.separator])]
        ids = np.concatenate([np.array([self.separator], dtype=np.uint32), *ids])
        cuts = np.flatnonzero(ids == self.separator)
        if len(cuts) != len(plain) + 1:
            raise ValueError("a plain word holds the separator")
        rest = [w for w, x in zip(words, easy) if not x]
        other = [e.ids for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)]
        easy = np.array(easy, dtype=bool)
        sizes, places = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        sizes[easy], places[easy] = np.diff(cuts) - 1, cuts[:-1] + 1
        sizes[~easy] = [len(x) for x in other]
        places[~easy] = len(ids) + np.cumsum(sizes[~easy]) - sizes[~easy]
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(other), dtype=np.uint32)])

        def room(a: np.ndarray, n: int) -> np.ndarray:
            return a if n <= len(a) else np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])

        lo, n = self.n_words, len(words)
        self.flat = room(self.flat, self.n_flat + len(ids))
        self.starts, self.sizes = room(self.starts, lo + n), room(self.sizes, lo + n)
        self.flat[self.n_flat:self.n_flat + len(ids)] = ids
        self.sizes[lo:lo + n], self.starts[lo:lo + n] = sizes, self.n_flat + places
        self.n_words, self.n_flat = lo + n, self.n_flat + len(ids)

    def cut(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words of texts of stable characters, and how many each text has."""
        if not texts:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        data = "\n".join([*texts, ""]).encode().lower()
        raw = np.frombuffer(data, dtype=np.uint8)
        kinds = _KINDS[raw]
        meet = kinds[1:] != kinds[:-1]
        # An apostrophe and letters after it may be one token.
        meet &= (raw[:-1] != ord("'")) | (kinds[1:] != _LETTER)
        starts = np.concatenate([[0], np.flatnonzero(meet) + 1])
        offsets = np.append(starts, len(raw)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        word = kinds[starts] != _SPACE
        codes = coded.indices.to_numpy()[word]
        used = np.zeros(len(coded.dictionary), dtype=bool)
        used[codes] = True
        numbers = np.zeros(len(used), dtype=np.int64)
        numbers[used] = [self.known[w] for w, x in zip(coded.dictionary.to_numpy(zero_copy_only=False), used.tolist()) if x]
        ends = np.cumsum(np.fromiter((len(t) if t.isascii() else len(t.encode()) for t in texts), dtype=np.int64, count=len(texts)) + 1)
        return numbers[codes], np.diff(np.searchsorted(starts[word], ends), prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end ids included, and the number of ids of each text."""
        if len(self.known) > CACHE_ENTRIES:
            self.reset()
        # A special token begins with "<|".
        stable = np.array([(t.isascii() or _STABLE.issuperset(t)) and "<|" not in t for t in texts], dtype=bool)
        split = [self.split(t) for t, x in zip(texts, stable) if not x]
        counts = np.zeros(len(texts), dtype=np.int64)
        counts[~stable] = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        numbers, counts[stable] = self.cut([t for t, x in zip(texts, stable) if x])
        inner = np.repeat(stable, counts)  # of each word: whether its text is stable
        both = np.empty(len(inner), dtype=np.int64)
        both[inner] = numbers
        both[~inner] = np.fromiter(map(self.known.__getitem__, chain.from_iterable(split)), dtype=np.int64,
                                   count=len(inner) - len(numbers))
        counts += 1
        words = np.zeros(int(counts.sum()), dtype=np.int64)
        ends = np.cumsum(counts)
        inner = np.ones(len(words), dtype=bool)
        inner[ends - 1] = False
        words[inner] = both
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        sizes = self.sizes[words]
        total = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[words] - (total - sizes), sizes) + np.arange(total[-1])]
        return ids, np.diff(total[ends - 1], prepend=0)


def compress(ids: np.ndarray, min_count: int = MIN_COUNT) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(first_rule, rules [r, 2], expansion lengths [r], symbols) of a sequence of ids."""
    first = int(ids.max()) + 1 if len(ids) else 0
    symbols = ids.astype(np.int64)
    rules: list[np.ndarray] = []
    n_rules = 0
    known = np.zeros(0, dtype=np.int64)  # pairs that have a rule, sorted, and its symbol
    known_symbols = np.zeros(0, dtype=np.int64)
    # A pair that is rare stays rare until one of its symbols is put in anew: only the other places are counted again.
    places = np.arange(max(0, len(symbols) - 1))
    while len(places):
        keys = symbols[places] << 32 | symbols[places + 1]
        # Slots of a hash table hold at least as many as each pair in them: pairs of thin slots are rare.
        slots = (keys * np.int64(0x9E3779B97F4A7C1) >> 40) & SLOT_MASK
        thick = np.bincount(slots, minlength=SLOT_MASK + 1)[slots] >= min_count if len(keys) > SLOT_MASK >> 3 else slice(None)
        places, keys = places[thick], keys[thick]
        coded = pa.array(keys).dictionary_encode()
        pairs, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        counts = np.bincount(which, minlength=len(pairs))
        often = np.flatnonzero(counts >= min_count)
        if not len(often):
            break
        often = often[np.lexsort((pairs[often], -counts[often]))]  # the most frequent first, ties by the pair
        none = len(often)
        rank = np.full(len(pairs), none, dtype=np.int64)
        rank[often] = np.arange(none)
        order = rank[which]
        places, order, pairs = places[order < none], order[order < none], pairs[often]
        # An occurrence is replaced if no neighbour that overlaps it comes before it; of a run of equals every other one.
        near = np.diff(places) == 1
        take = np.ones(len(places), dtype=bool)
        take[1:] &= ~near | (order[1:] <= order[:-1])
        take[:-1] &= ~near | (order[:-1] <= order[1:])
        at, order_at = places[take], order[take]
        begins = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        run = np.repeat(begins, np.diff(np.append(begins, len(at))))
        alternate = (np.arange(len(at)) - run) % 2 == 0
        at, order_at = at[alternate], order_at[alternate]
        keep = np.bincount(order_at, minlength=none) >= 2
        at, order_at = at[keep[order_at]], order_at[keep[order_at]]
        if not len(at):
            break
        # A pair that was overlapped in an earlier round has its rule already.
        spot = np.searchsorted(known, pairs)
        had = spot < len(known)
        had[had] = known[spot[had]] == pairs[had]
        fresh = keep & ~had
        symbol = first + n_rules + np.cumsum(fresh) - 1
        symbol[had] = known_symbols[spot[had]]
        made = pairs[fresh]
        rules.append(np.stack([made >> 32, made & 0xFFFFFFFF], axis=1))
        n_rules += len(made)
        known, known_symbols = np.append(known, made), np.append(known_symbols, symbol[fresh])
        sort = np.argsort(known)
        known, known_symbols = known[sort], known_symbols[sort]
        symbols[at] = symbol[order_at]
        stay = np.ones(len(symbols), dtype=bool)
        stay[at + 1] = False
        again = np.zeros(len(symbols) + 1, dtype=bool)
        again[places] = True
        again[at] = True
        again = again[:-1][stay]
        symbols = symbols[stay]
        new_at = at - np.arange(len(at))  # one place goes with each replacement before
        again[np.maximum(new_at - 1, 0)] = True
        if (keep & had).any():  # old symbols stand in new places: their pairs may have become frequent
            back = np.zeros(first + n_rules, dtype=bool)
            back[symbol[keep & had]] = True
            hit = back[symbols]
            again |= hit
            again[:-1] |= hit[1:]
        places = np.flatnonzero(again[:-1])
    table = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    lengths, done = np.ones(len(table), dtype=np.int64), 0
    for made in rules:  # a rule names symbols of earlier rounds only
        left, right = (np.where(s < first, 1, lengths[np.maximum(s - first, 0)]) for s in made.T)
        lengths[done:done + len(made)] = left + right
        done += len(made)
    return first, table.astype("<u4"), lengths.astype("<u4"), symbols.astype("<u4")


def expand(symbols: np.ndarray, first: int, rules: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids that a sequence of symbols stands for."""
    lengths = lengths.astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.zeros(int(lengths.sum()), dtype=np.int64)  # the expansions of all rules, one after another
    for (a, b), at, end in zip(rules.tolist(), starts.tolist(), (starts + lengths).tolist()):
        for s in (a, b):  # a rule names earlier symbols only
            if s < first:
                flat[at] = s
                at += 1
            else:
                n = int(lengths[s - first])
                flat[at:at + n] = flat[starts[s - first]:starts[s - first] + n]
                at += n
        assert at == end
    symbols = symbols.astype(np.int64)
    big = symbols >= first
    rule = np.where(big, symbols - first, 0)
    sizes = np.where(big, lengths[rule], 1) if len(lengths) else np.ones(len(symbols), dtype=np.int64)
    out = np.repeat(symbols, sizes)
    ends = np.cumsum(sizes)
    if big.any():
        n = sizes[big]
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat((ends - sizes)[big], n) + inside] = flat[np.repeat(starts[rule[big]], n) + inside]
    return out.astype("<u4")


def decode_slice(shard: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (exclusive) of a shard; only the symbols that cover them are expanded."""
    rules = np.frombuffer(shard["rules"], "<u4").reshape(-1, 2).astype(np.int64)
    lengths = np.frombuffer(shard["lengths"], "<u4").astype(np.int64)
    symbols = np.frombuffer(shard["symbols"], "<u4").astype(np.int64)
    first = int(shard["first_rule"])
    start, stop = max(0, start), min(stop, int(shard["n_tokens"]))
    if start >= stop:
        return np.zeros(0, dtype="<u4")
    sizes = np.ones(len(symbols), dtype=np.int64)
    big = symbols >= first
    sizes[big] = lengths[symbols[big] - first]
    ends = np.cumsum(sizes)
    lo, hi = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    skipped = int(ends[lo] - sizes[lo])
    return expand(symbols[lo:hi], first, rules, lengths)[start - skipped:stop - skipped]


def _shard_row(part: int, shard: int, before: int, ids: np.ndarray, doc_ids: list, sizes: np.ndarray) -> pd.DataFrame:
    first, rules, lengths, symbols = compress(ids)
    return pd.DataFrame({
        "part": [part], "shard": [shard], "part_start": [before], "n_tokens": [len(ids)], "first_rule": [first],
        "rules": [rules.tobytes()], "lengths": [lengths.tobytes()], "symbols": [symbols.tobytes()],
        "doc_ids": [doc_ids], "doc_tokens": [sizes.tolist()]})


_ENCODERS: dict[tuple[str, int], WordEncoder] = {}


def write_shards(docs: DataFrame, path: str, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                 doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode ``docs`` and write the shards to the folder ``path``."""
    ship(docs.sparkSession)

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        key = (tokenizer_path(tokenizer), end_id)
        encoder = _ENCODERS.get(key) or _ENCODERS.setdefault(key, WordEncoder(*key))
        part, shard, before = TaskContext.get().partitionId(), 0, 0
        names, sizes, ids = [], [], []
        held = 0
        for batch in batches:
            numbers = [None if pd.isna(i) else int(i) for i in batch["i"]]
            texts = [t or "" for t in batch["t"]]
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and chars < GROUP_CHARS:
                    chars += len(texts[hi])
                    hi += 1
                got, counts = encoder.encode(texts[lo:hi])
                ids.append(got)
                sizes.append(counts)
                names += numbers[lo:hi]
                held += len(got)
                lo = hi
                if held >= SHARD_TOKENS:
                    yield _shard_row(part, shard, before, np.concatenate(ids), names, np.concatenate(sizes))
                    shard, before = shard + 1, before + held
                    names, sizes, ids, held = [], [], [], 0
        if names:
            yield _shard_row(part, shard, before, np.concatenate(ids), names, np.concatenate(sizes))

    (docs.select(F.col(doc_id).cast("bigint").alias("i"), F.col(text).alias("t"))
     .repartitionByRange("i").sortWithinPartitions("i", "t")
     .mapInPandas(shards, SHARD_SCHEMA).write.parquet(path))


def read_documents(spark: SparkSession, path: str, doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards at ``path``."""
    ship(spark)

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch.to_dict("records"):
                ids = decode_slice(shard, 0, int(shard["n_tokens"]))
                sizes = np.asarray(shard["doc_tokens"], dtype=np.int64)
                ends = np.cumsum(sizes)
                data = memoryview(ids.tobytes())
                names = [None if i is None or i != i else int(i) for i in shard["doc_ids"]]
                yield pd.DataFrame({
                    "doc": pd.array(names, dtype="Int64"), "part": shard["part"],
                    "inside": ends - sizes + int(shard["part_start"]), "n_tokens": sizes,
                    "ids_crc32": [zlib.crc32(data[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]})

    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each range of ids
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rows = shards.mapInPandas(decoded, "doc bigint, part int, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(bases, "part").select(
        F.col("doc").alias(doc_id), (F.col("inside") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def encode_and_read(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, path, tokenizer, end_id)
    return read_documents(docs.sparkSession, path)
