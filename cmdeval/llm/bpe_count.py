"""Operator 4: token counts of byte-level BPE by heap and linked list.

The symbols of a pre-token are its bytes. A heap holds the rank of every
adjacent pair that a merge rule names; popping the lowest rank (leftmost on
ties) joins two neighbours in a doubly linked list and pushes the two new
pairs. The count is the number of initial symbols minus the merges done; no
token id is ever emitted. A pre-token of n bytes costs O(n log n), so a very
long run of letters is no trouble.

Texts are cut before every run of blanks and line feeds: no pre-token crosses
such a place. Each worker remembers the counts of the pieces it has met
(bounded by ``CACHE_ENTRIES``; a full cache is emptied, which changes the time
only). Null text counts as empty; an empty text has 0 tokens.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

CACHE_ENTRIES = 800_000
LONG_TEXT = 1 << 20

_PIECES = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than blank and line feed: a cut beside it could part a run of white space.
_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0  -     　]")
#: Fixed value: the pre-token pattern of byte-level BPE.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others take 256, 257, ... in order."""
    visible = {b for lo, hi in ((33, 126), (161, 172), (174, 255)) for b in range(lo, hi + 1)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


class MergeCounter(dict):
    """Piece of text -> its token count; computes what it hasn't met."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if (model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"]
                or not pre["use_regex"] or model.get("ignore_merges")):
            raise ValueError(f"{path} is not plain byte-level BPE")
        vocab = model["vocab"]
        self.first = [vocab[c] for c in byte_symbols()]
        if len(vocab) > 1 << 16:
            raise ValueError("ids over 16 bits are not supported")
        self.rank_of, self.result, self.known = {}, [], {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[vocab[a] << 16 | vocab[b]] = rank
            self.result.append(vocab[a + b])
        added = spec["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added):
            raise ValueError("only plain added tokens are supported")
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        self.pretokens = regex.compile(PRETOKEN).findall

    def merged(self, word: bytes) -> int:
        """Symbols left of one pre-token when no rule applies any more."""
        rank_of, result = self.rank_of.get, self.result
        symbols = [self.first[b] for b in word]
        n = left = len(symbols)
        ranks = [rank_of(a << 16 | b) for a, b in zip(symbols, symbols[1:])]  # of the pair that starts here
        heap = [rank << 32 | i for i, rank in enumerate(ranks) if rank is not None]
        if not heap:
            return left
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if ranks[i] != rank:
                continue  # one of the two has merged since
            left -= 1
            symbol = symbols[i] = result[rank]
            j = after[i]
            k = after[i] = after[j]
            if j < n - 1:
                ranks[j] = None
            if k < n:
                before[k] = i
                rank = ranks[i] = rank_of(symbol << 16 | symbols[k])
                if rank is not None:
                    heappush(heap, rank << 32 | i)
            else:
                ranks[i] = None
            k = before[i]
            if k >= 0:
                rank = ranks[k] = rank_of(symbols[k] << 16 | symbol)
                if rank is not None:
                    heappush(heap, rank << 32 | k)
        return left

    def counted(self, pretoken: str) -> int:
        count = self.known.get(pretoken)
        if count is None:
            count = self.merged(pretoken.encode("utf-8", "replace"))
            if len(pretoken) <= 64:
                if len(self.known) >= CACHE_ENTRIES:
                    self.known.clear()
                self.known[pretoken] = count
        return count

    def __missing__(self, piece: str) -> int:
        count = sum(map(self.counted, self.pretokens(piece)))
        if len(piece) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[piece] = count
        return count

    def count(self, text: str) -> int:
        if self.special and (parts := self.special.split(text))[1:]:
            return len(parts) - 1 + sum(map(self.count, parts))
        if _OTHER_SPACE.search(text):
            return sum(map(self.counted, self.pretokens(text)))
        if len(text) > LONG_TEXT:  # one by one: no list of all pieces
            return sum(self[m.group()] for m in _PIECES.finditer(text))
        return sum(map(self.__getitem__, _PIECES.findall(text)))


_COUNTERS: dict[str, MergeCounter] = {}


def counter(path: str) -> MergeCounter:
    """One counter per worker process and file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = MergeCounter(path)
    return _COUNTERS[path]


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Columns of these names are replaced; all others pass. One narrow Arrow pass
    over the text column, no shuffle.
    """
    ship(docs.sparkSession)

    @F.pandas_udf("bigint")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = counter(tokenizer_path(tokenizer))
        for texts in batches:
            yield pd.Series([c.count(t) if t else 0 for t in texts], dtype="int64")

    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint"))
            .withColumn("n_tokens", tokens(F.col(text)))
            .withColumn("over_limit", F.col("n_tokens") > limit))
