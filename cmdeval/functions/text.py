"""Text Column expressions. All run JVM-side (built-in functions and lambdas)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (CODE_FENCE, COMMENT_MARK, IM_END, IM_START, POSIX_BLANK,
                         PY_WHITESPACE, TOKEN_PATTERN_JAVA)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: trims Unicode whitespace at both ends.

    Spark's one-argument ``trim`` only removes the space character.
    """
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def lines(c: Column | str) -> Column:
    """``str.split("\\n")``; an empty string gives one empty line."""
    return F.split(_col(c), "\n", -1)


def clean_command(c: Column | str) -> Column:
    """Reduce a raw model answer to one command.

    Strip, split into lines, strip each line, drop fence lines (starting with
    three backticks), empty lines and ``#`` lines; keep the last survivor.
    With no survivor, return the stripped text without backticks.
    """
    text = strip(c)
    kept = F.filter(
        F.transform(lines(text), strip),
        lambda ln: (ln != F.lit("")) & ~ln.startswith(CODE_FENCE) & ~ln.startswith(COMMENT_MARK),
    )
    fallback = strip(F.replace(text, F.lit("`"), F.lit("")))
    return F.coalesce(F.try_element_at(kept, F.lit(-1)), fallback)


def last_line(c: Column | str) -> Column:
    """The ``ask`` post-filter: drop ``\\r``, drop blank lines, keep the last.

    No trimming; NULL when no line is left.
    """
    kept = F.filter(
        lines(F.replace(_col(c), F.lit("\r"), F.lit(""))),
        lambda ln: F.trim(ln, F.lit(POSIX_BLANK)) != F.lit(""),
    )
    return F.try_element_at(kept, F.lit(-1))


def cut_at_stop(c: Column | str) -> Column:
    """Generated text up to the first end-of-turn or start-of-turn marker."""
    head = F.split_part(_col(c), F.lit(IM_END), F.lit(1))
    return F.split_part(head, F.lit(IM_START), F.lit(1))


def tokens(c: Column | str) -> Column:
    """Lower-cased word runs and single non-space symbols (Unicode classes)."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN_JAVA), 0)


def next_order(prev: Column | str, tok: Column | str, n: int) -> Column:
    """Order-``n`` grams from the order ``n-1`` grams and the tokens (one zip)."""
    prev, tok = _col(prev), _col(tok)
    width = F.greatest(F.size(tok) - F.lit(n - 1), F.lit(0))
    return F.zip_with(F.slice(prev, 1, width), F.slice(tok, n, width),
                      lambda a, b: F.concat(a, F.lit(" "), b))
