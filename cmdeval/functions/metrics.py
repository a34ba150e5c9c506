"""Per-pair metric Column expressions.

Token F1 and BLEU-4 need multiset intersections of token / n-gram bags.
They are computed inside the row. Grams are 64-bit codes: a token's hash, and for
order n the hash of the order n-1 code with the next token's. Bags are compared
within one pair only, by 63 bits: two different grams of a pair with k grams agree
with a chance of about k * k / 2 ** 64 (1e-13 for texts of 1,000 tokens), and a
count is then off by one. Sets are intersected, and what repeats is sorted together
as numbers and counted in one pass (O(n log n)). No lambda refers to a column of
the row, so optimizer rewrites cannot turn it quadratic. No shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (BLEU_DIGITS, BLEU_MAX_ORDER, BLEU_SMOOTHING, BLEU_WEIGHT,
                         SINGLE_LINE_MAX_LINES)
from .text import _col, lines, strip


def exact_match(pred: Column | str, gold: Column | str, lowered: bool = False) -> Column:
    """1.0 when the stripped, lower-cased texts are equal, else 0.0; ``lowered`` texts are in lower case already (white
    space has no case, so it may be stripped before or after)."""
    pred, gold = (strip(c) if lowered else F.lower(strip(c)) for c in (pred, gold))
    return F.when(pred == gold, F.lit(1.0)).otherwise(F.lit(0.0))


def single_line(raw: Column | str) -> Column:
    """1 when the (already stripped) raw answer has at most two lines."""
    return F.when(F.size(lines(raw)) <= SINGLE_LINE_MAX_LINES, F.lit(1)).otherwise(F.lit(0))


def output_chars(raw: Column | str) -> Column:
    return F.length(_col(raw)).cast("bigint")


def round_half_even(x: Column, digits: int) -> Column:
    """``round(x, digits)`` done as half-even on ``x * 10**digits``.

    Written so DuckDB can repeat it bit for bit (``round_even(x*10^d, 0)/10^d``).
    """
    scale = float(10 ** digits)
    return F.bround(x * F.lit(scale), 0) / F.lit(scale)


def round_exact(x: Column, digits: int) -> Column:
    """Python's ``round(x, digits)``: to the nearest decimal of the number that the double is, half to even.

    ``x * 10**digits`` is rounded to a double; what that drops is got back by splitting x into two short halves
    (Dekker's product), and where the product looks like a tie it tells the side. For up to 8 digits.
    """
    if not 0 <= digits <= 8:
        raise ValueError("digits must be from 0 to 8")
    s = float(10 ** digits)

    def rounded(v: Column) -> Column:
        y = v * F.lit(s)
        near = F.rint(y)
        far = F.lit(134217729.0) * v
        high = far - (far - v)
        dropped = (high * F.lit(s) - y) + (v - high) * F.lit(s)
        tie = F.abs(y - near) == 0.5
        whole = (F.when(tie & (dropped > 0), F.ceil(y).cast("double")).when(tie & (dropped < 0), F.floor(y).cast("double"))
                 .otherwise(near))
        return F.when(F.abs(y) < float(1 << 52), whole / F.lit(s)).otherwise(v)

    return _bound(x, rounded)


def exact_sum(x: Column, bits: int) -> Column:
    """Sum of doubles as whole multiples of ``2 ** -bits``: the same bits however the rows are dealt out.

    Values are rounded to such a multiple first (no change for scores of at least 0.5 at 53 bits); they must be
    below ``2 ** (63 - bits)``, others and NaN count as absent.
    """
    scale = F.lit(float(1 << bits))
    return F.sum(F.rint(x * scale).try_cast("bigint").cast("decimal(20,0)")).cast("double") / scale


#: Fixed-point bits of scores (0 to 1) and of seconds.
SCORE_BITS, SECONDS_BITS = 53, 32


def plain_number(x: Column) -> Column:
    """A double as Python prints it, without an exponent from 0.0001 up to 10 ** 16."""
    text = x.cast("string")
    digits = F.regexp_replace(x.cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    fixed = (F.abs(x) >= 1e-4) & (F.abs(x) < 1e16)
    return F.when(text.contains("E") & fixed, digits).otherwise(text)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _shifted(arr: Column) -> Column:
    """An array of numbers moved on by one place, null first."""
    return F.concat(F.array(F.lit(None).cast("bigint")), F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0))))


def _repeats(arr: Column) -> Column:
    """The copies beyond the first of every element."""
    return _bound(F.sort_array(arr), lambda s: F.array_compact(F.zip_with(s, _shifted(s), lambda x, y: F.when(x == y, x))))


def multiset_overlap(pred: Column | str, gold: Column | str) -> Column:
    """``sum((Counter(pred) & Counter(gold)).values())`` for two arrays of 64-bit gram codes.

    A gram that both hold matches once; beyond that its further copies match as far as both have some. The first
    part is a set intersection, the second concerns only repeated grams, and only pairs in which both sides repeat.
    """
    pred, gold = _col(pred), _col(gold)
    repeats = (F.size(F.array_distinct(pred)) < F.size(pred)) & (F.size(F.array_distinct(gold)) < F.size(gold))
    return F.size(F.array_intersect(pred, gold)) + F.when(
        repeats, _multiset_matches(_repeats(pred), _repeats(gold))).otherwise(F.lit(0))


def _multiset_matches(pred: Column, gold: Column) -> Column:
    """Matches of two bags that may hold copies.

    Both are sorted together as plain numbers, the last bit telling the side, so every gram's pred copies (even) come
    right before its gold copies (odd). Each number is compared with the one before it, and a fold over the
    outcomes carries one number: matches in the high half, unmatched pred copies in the low half.
    """
    even, one, half = F.lit(-2).cast("bigint"), F.lit(1).cast("bigint"), 1 << 31
    merged = F.sort_array(F.concat(F.transform(pred, lambda x: x.bitwiseAND(even)), F.transform(gold, lambda x: x.bitwiseOR(one))))
    # 0: a pred copy that begins a run, 1: a further one, 2: a gold copy that begins a run, 3: a further one.
    kind = _bound(merged, lambda m: F.zip_with(m, _shifted(m), lambda x, y: F.when(
        x.bitwiseXOR(y).bitwiseAND(even) == 0, F.lit(1)).otherwise(F.lit(0)) + x.bitwiseAND(one).cast("int") * 2))

    def step(acc: Column, k: Column) -> Column:
        low = acc.bitwiseAND(F.lit(half - 1).cast("bigint"))
        return (F.when(k == 1, acc + 1)
                .when(k == 3, F.when(low > 0, acc + F.lit(half - 1).cast("bigint")).otherwise(acc))
                .when(k == 0, acc - low + 1)
                .otherwise(acc - low))

    return F.aggregate(kind, F.lit(0).cast("bigint"), step, lambda acc: F.shiftright(acc, 31).cast("int"))


def token_codes(tokens: Column | str) -> Column:
    """64-bit hashes of tokens."""
    return F.transform(_col(tokens), lambda t: F.xxhash64(t))


def next_codes(prev: Column | str, tok: Column | str, n: int) -> Column:
    """Codes of order-``n`` grams from those of order ``n - 1`` and of the tokens (one zip)."""
    prev, tok = _col(prev), _col(tok)
    width = F.greatest(F.size(tok) - F.lit(n - 1), F.lit(0))
    return F.zip_with(F.slice(prev, 1, width), F.slice(tok, n, width), lambda a, b: F.xxhash64(a, b))


def f1_from_counts(match1: Column, n_pred: Column, n_gold: Column) -> Column:
    """Token F1 from the unigram overlap and the two token counts."""
    precision = F.lit(1.0) * match1 / n_pred
    recall = F.lit(1.0) * match1 / n_gold
    return (F.when((n_pred == 0) | (n_gold == 0) | (match1 == 0), F.lit(0.0))
            .otherwise((F.lit(2.0) * precision * recall) / (precision + recall)))


def bleu4_from_counts(matches: list[Column], n_pred: Column, n_gold: Column) -> Column:
    """Sentence BLEU-4 with add-0.1 smoothing on both terms.

    An order is left out when either side is shorter than n; weights are not
    renormalised; an empty prediction scores 0.
    """
    log_sum = F.lit(0.0)
    for n in range(1, BLEU_MAX_ORDER + 1):
        total = F.greatest(n_pred - F.lit(n - 1), F.lit(1))
        p_n = (matches[n - 1] + F.lit(BLEU_SMOOTHING)) / (total + F.lit(BLEU_SMOOTHING))
        term = F.when((n_pred >= n) & (n_gold >= n), F.lit(BLEU_WEIGHT) * F.log(p_n)).otherwise(F.lit(0.0))
        log_sum = log_sum + term
    brevity = (F.when(n_pred < n_gold, F.exp(F.lit(1.0) - n_gold / F.greatest(n_pred, F.lit(1))))
               .otherwise(F.lit(1.0)))
    # Rounded at 1e-12: exp/ln differ by an ulp between engines; this keeps the
    # score engine-independent without changing any reported digit.
    return F.when(n_pred == 0, F.lit(0.0)).otherwise(round_half_even(brevity * F.exp(log_sum), BLEU_DIGITS))
