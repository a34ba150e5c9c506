"""Bags of n-grams in Arrow batches: many rows are coded and counted in one numpy pass.

Grams are exact codes, numbered inside a row: a token's place among the row's distinct tokens, and for order n the
place of the pair (order n-1 gram, next token). Nothing is hashed to a fixed width, so no two grams are mixed up.
A batch is worked off in slices of about ``SLICE_BYTES`` of text, which bounds a worker's memory and stays in its
cache. Texts come lower-cased by Spark, as ``functions.text.tokens`` lower-cases them, and are cut here by the
pattern that its Java pattern stands for.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BLEU_MAX_ORDER, TOKEN_PATTERN_PYTHON
from ..functions.text import _col

SLICE_BYTES = 1 << 16
#: Tokens of a slice whose grams of all orders are held at once, rows of a batch of counts, and places of a text whose
#: grams come before those of the next text.
TOGETHER, BATCH_ROWS, PLACES = 1 << 16, 1 << 18, 4
ORDERS = tuple(range(1, BLEU_MAX_ORDER + 1))
#: What a character is to the token pattern.
SPACE, WORD, SYMBOL = 0, 1, 2


def _kinds(stop: int) -> np.ndarray:
    """Kinds of the characters below ``stop``, as the pattern itself takes them."""
    kinds = np.zeros(stop, np.uint8)
    for found in _runs.finditer("".join(map(chr, range(stop)))):
        kinds[found.start():found.end()] = WORD if _word.match(found[0]) else SYMBOL
    return kinds


#: Runs of word characters, or of symbols: the last class of the pattern, repeated.
_runs, _word = re.compile(TOKEN_PATTERN_PYTHON + "+"), re.compile(r"\w")
_ASCII = np.append(_kinds(0x80), np.zeros(0x80, np.uint8))


@functools.cache
def _unicode() -> np.ndarray:
    return _kinds(0x110000)


def prepared(text: Column | str) -> Column:
    """A text as this module takes it."""
    return F.make_valid_utf8(F.lower(_col(text)))


def _kinds_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte's character in UTF-8, and the places of bytes that go on with a character."""
    kinds, high = _ASCII[data], np.flatnonzero(data >= 0x80)
    if not len(high):
        return kinds, high
    rest = data[high]
    begins = (rest & 0xC0) != 0x80
    points = np.frombuffer(rest.tobytes().decode().encode("utf-32-le"), "<u4")
    kinds[high] = _unicode()[points][np.cumsum(begins) - 1]
    return kinds, high[~begins]


def _tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The tokens of all texts one after the other, and how many each has; null has none.

    The bytes of all texts are cut at once: without white space the tokens stand one right after the other.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    kinds, inner = _kinds_of(data)
    word, solid = kinds == WORD, kinds != SPACE
    start = solid.copy()
    start[1:] &= ~(word[1:] & word[:-1])
    edges = ends[ends < len(data)]
    start[edges] = solid[edges]
    start[inner] = False
    data, places = data[solid], np.flatnonzero(start[solid])
    tokens = pa.StringArray.from_buffers(
        len(places), pa.py_buffer(np.append(places, len(data)).astype(np.int32)), pa.py_buffer(data))
    return tokens, np.diff(np.searchsorted(np.flatnonzero(start), ends))


def slices(*columns: pa.Array, size: int = SLICE_BYTES, rows: int = 1 << 31) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` rows and about ``size`` bytes; a row with more is a range of its own."""
    sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + size, "right"))))
        yield start, stop
        start = stop


def _dense(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 for equal keys, and how many there are."""
    codes, known = pd.factorize(keys)
    return codes, len(known)


def _grams(tokens: pa.Array, part: np.ndarray, group: np.ndarray,
           orders: int = len(ORDERS)) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(n, starts, codes, number of codes) of the orders up to ``orders``.

    ``part`` is the text that a token stands in, grams end with it; grams of one ``group`` share codes.
    """
    words = tokens.dictionary_encode()
    first, k = _dense(group * max(1, len(words.dictionary)) + words.indices.to_numpy())
    starts, size, codes = np.arange(len(first)), k, first.copy()
    yield 1, starts, first, k
    for n in ORDERS[1:orders]:
        starts = starts[starts + n <= len(first)]
        starts = starts[part[starts] == part[starts + (n - 1)]]
        found, k = _dense(codes[starts] * max(1, size) + first[starts + (n - 1)])
        codes[starts] = found
        yield n, starts, found, k


def _matched(pred: pa.Array, gold: pa.Array, orders: int) -> np.ndarray:
    """Tokens of either side and matches of each order (columns) of the rows of a slice."""
    rows = len(pred)
    (pred, n_pred), (gold, n_gold) = _tokens(pred), _tokens(gold)
    split = len(pred)
    group = np.concatenate([np.repeat(np.arange(rows), n_pred), np.repeat(np.arange(rows), n_gold)])
    part = group.copy()
    part[split:] += rows
    out = np.zeros((rows, 2 + orders), np.int32)
    out[:, 0], out[:, 1] = n_pred, n_gold
    for n, starts, codes, k in _grams(pa.concat_arrays([pred, gold]), part, group, orders):
        mine = starts < split
        both = np.minimum(np.bincount(codes[mine], minlength=k), np.bincount(codes[~mine], minlength=k))
        owner = np.zeros(k, np.int64)
        owner[codes] = group[starts]
        out[:, n + 1] = np.bincount(owner, weights=both, minlength=rows)
    return out


def matched(pred: pa.Array, gold: pa.Array, orders: int = len(ORDERS)) -> pa.Array:
    """For each row its tokens of either side and the multiset intersection's size of the orders up to
    ``orders``, as a list; null texts hold nothing."""
    found = [_matched(pred.slice(a, b - a), gold.slice(a, b - a), orders) for a, b in slices(pred, gold)]
    flat = np.concatenate(found or [np.zeros((0, 2 + orders), np.int32)]).ravel()
    return pa.ListArray.from_arrays(np.arange(len(pred) + 1, dtype=np.int32) * (2 + orders), pa.array(flat, pa.int32()))


def overlaps(pred: Column | str, gold: Column | str, orders: int = len(ORDERS)) -> Column:
    """Column of ``matched`` (array of int) for two columns of lower-cased text."""
    def found(pred: pa.Array, gold: pa.Array) -> pa.Array:
        return matched(pred, gold, orders)
    return F.arrow_udf(found, "array<int>")(F.make_valid_utf8(_col(pred)), F.make_valid_utf8(_col(gold)))


def _counted(texts: pa.Array, sides: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]]:
    """Rows, sides, orders, grams and counts of a slice; ``texts`` has the sides of each row one after the other.

    Equal texts are counted once. Rows next to each other that agree in a side (the models' answers to one sample) share
    their codes. For every few of the places where these grams begin first, all orders come, one holder after the other:
    a writer's compression then finds a holder's grams just before. Of a slice with very many tokens each order comes by
    itself, which bounds what is held at once.
    """
    texts = texts.dictionary_encode()
    of = pc.fill_null(texts.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(texts.dictionary):
        return
    rows = of.reshape(-1, sides)
    run = np.cumsum(np.append(True, ((rows[1:] != rows[:-1]) | (rows[1:] < 0)).all(1)))
    holders = np.argsort(of, kind="stable")[np.count_nonzero(of < 0):]  # of each text in turn
    times = np.bincount(of[holders])
    first = np.cumsum(times) - times
    tokens, sizes = _tokens(texts.dictionary)
    text = np.repeat(np.arange(len(sizes)), sizes)
    parts = []
    for n, starts, codes, k in _grams(tokens, text, run[holders[first] // sides][text]):
        place = np.zeros(k, np.int64)
        place[codes[::-1]] = starts[::-1]
        words = [tokens.take(pa.array(place + i)) for i in range(n)]
        grams = pc.binary_join_element_wise(*words, " ") if n > 1 else words[0]
        held, pairs = pd.factorize(text[starts] * max(1, k) + codes)
        owner, code = np.divmod(pairs, max(1, k))
        parts.append((np.full(len(pairs), n), owner, code, place[code], np.bincount(held, minlength=len(pairs)), grams))
        if n == ORDERS[-1] or len(tokens) > TOGETHER:
            yield from _by_place(parts, times, first, holders, sides)
            parts = []


def _by_place(parts: list, times: np.ndarray, first: np.ndarray, holders: np.ndarray, sides: int) -> Iterator[tuple]:
    """The rows of ``_counted``: each gram of a text for each of the text's holders."""
    before = np.cumsum([0, *[len(p[-1]) for p in parts[:-1]]])
    grams = pa.concat_arrays([p[-1] for p in parts])
    n, owner, code, place, count = (np.concatenate(x) for x in zip(*[(*p[:2], p[2] + b, *p[3:5]) for p, b in zip(parts, before)]))
    many = times[owner]
    each = np.repeat(np.arange(len(owner)), many)
    holder = holders[(first[owner] - np.cumsum(many) + many)[each] + np.arange(len(each))]
    block, rest = np.divmod(place, PLACES)
    order = np.argsort((block[each] * (holders.max() + 1) + holder) * (PLACES * 8) + (rest * 8 + n)[each])
    for at in range(0, len(order), BATCH_ROWS):
        some = order[at:at + BATCH_ROWS]
        row, side = np.divmod(holder[some], sides)
        some = each[some]
        yield row, side, n[some], grams.take(pa.array(code[some])), count[some]


def counter(keys: list[str], sides: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of Arrow batches: a row for each distinct gram of each of the text columns ``sides`` (name to label)."""
    labels = pa.array(list(sides.values()))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(name) for name in sides]
            for a, b in slices(*columns, size=len(sides) * SLICE_BYTES):
                beside = np.arange(len(sides) * (b - a)).reshape(len(sides), -1).T.ravel()
                texts = pa.concat_arrays([c.slice(a, b - a) for c in columns]).take(pa.array(beside))
                for row, side, n, grams, cnt in _counted(texts, len(sides)):
                    at = pa.array(row + a)
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).take(at) for c in keys], labels.take(pa.array(side)),
                         pa.array(n.astype(np.int64)), grams, pa.array(cnt.astype(np.int64))],
                        names=[*keys, "side", "n", "gram", "cnt"])
    return counted
