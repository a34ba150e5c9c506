import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cmdeval.constants import PY_WHITESPACE_CODEPOINTS, TOKEN_PATTERN_JAVA
from cmdeval.functions import (bleu4_from_counts, clean_command, cut_at_stop, exact_match,
                               f1_from_counts, last_line, multiset_overlap, next_codes,
                               next_order, plain_number, round_exact, single_line, strip, token_codes, tokens)
from cmdeval.functions.metrics import exact_sum


GOLDEN = [  # prediction, gold, em, f1, bleu4
    ("df -h", "df -h", 1.0, 1.0, 1.0),
    ("DF -H", "df -h", 1.0, 1.0, 1.0),
    ("pwd", "pwd", 1.0, 1.0, 1.0),
    ("ls", "pwd", 0.0, 0.0, 0.5491),
    ("", "pwd", 0.0, 0.0, 0.0),
    ("ls", "", 0.0, 0.0, 1.0),
    ("grep -rn TODO src/", "grep -rn 'TODO' src/", 0.0, 0.857143, 0.192972),
    ("find . -name '*.py'", "find . -type f -name '*.py'", 0.0, 0.857143, 0.624621),
    ("sort -r -u names.txt", "sort -u -r names.txt", 0.0, 1.0, 0.224492),
    ("echo a a a", "echo a", 0.0, 0.666667, 0.65293),
]

CLEANING = [  # raw, clean, single_line, ask last line
    ("df -h", "df -h", 1, "df -h"),
    ("```bash\nls -la\n```", "ls -la", 0, "```"),
    ("```bash\nls\n```\nThis lists files", "This lists files", 0, "This lists files"),
    ("# only comment", "# only comment", 1, "# only comment"),
    ("```ls -la```", "ls -la", 1, "```ls -la```"),
    ("", "", 1, None),
    ("  \r\nA\r\n\r\n B \r\n", "B", 0, " B "),
    ("`pwd`", "`pwd`", 1, "`pwd`"),
    ("```\n```", "", 1, "```"),
]


def score_rows(spark, rows):
    df = spark.createDataFrame(rows, "p string, g string")
    df = df.withColumn("pt", token_codes(tokens("p"))).withColumn("gt", token_codes(tokens("g")))
    ms = []
    df = df.withColumn("p_n", F.col("pt")).withColumn("g_n", F.col("gt"))
    for n in range(1, 5):
        if n > 1:
            df = df.withColumn("p_n", next_codes("p_n", "pt", n)).withColumn("g_n", next_codes("g_n", "gt", n))
        df = df.withColumn(f"m{n}", multiset_overlap("p_n", "g_n"))
        ms.append(F.col(f"m{n}"))
    np_, ng = F.size("pt"), F.size("gt")
    return df.select("p", "g", exact_match("p", "g").alias("em"), f1_from_counts(F.col("m1"), np_, ng).alias("f1"),
                     bleu4_from_counts(ms, np_, ng).alias("bleu4")).collect()


def test_golden_vectors(spark):
    got = score_rows(spark, [(p, g) for p, g, *_ in GOLDEN])
    for row, (p, g, em, f1, bleu) in zip(got, GOLDEN):
        assert row.em == em, (p, g)
        assert row.f1 == pytest.approx(f1, abs=1e-6), (p, g)
        assert row.bleu4 == pytest.approx(bleu, abs=1e-4), (p, g)


def test_cleaning_table(spark):
    df = spark.createDataFrame([(r,) for r, *_ in CLEANING], "raw string")
    got = df.select(clean_command("raw").alias("c"), single_line(strip("raw")).alias("s"),
                    last_line("raw").alias("l")).collect()
    for row, (raw, c, s, l) in zip(got, CLEANING):
        assert (row.c, row.s, row.l) == (c, s, l), repr(raw)


def test_cut_at_stop(spark):
    rows = [("ls<|im_end|>\nmore",), ("a<|im_start|>user\nb",), ("plain",), ("",)]
    got = [r.c for r in spark.createDataFrame(rows, "x string").select(cut_at_stop("x").alias("c")).collect()]
    assert got == ["ls", "a", "plain", ""]


def test_whitespace_set_is_python_isspace():
    assert [c for c in range(0x110000) if chr(c).isspace()] == list(PY_WHITESPACE_CODEPOINTS)


def words(text):
    return re.findall(r"\w+|[^\w\s]", text.lower())


ALPHABET = st.sampled_from(list("ab c-_.'\"$()|&;\t\n\r`#éßÄ1") + [" ", " ", "```", "\n#"])
TEXT = st.lists(ALPHABET, max_size=40).map("".join)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=25))
def test_metrics_match_python_definitions(spark, pairs):
    got = score_rows(spark, pairs)
    for row, (p, g) in zip(got, pairs):
        assert row.em == (1.0 if p.strip().lower() == g.strip().lower() else 0.0)
        assert 0.0 <= row.f1 <= 1.0
        if words(p):
            assert 0.0 < row.bleu4 <= 1.0 + 1e-12


@settings(max_examples=20, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=25))
def test_strip_tokens_clean_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(strip("t").alias("s"), tokens("t").alias("k"), clean_command("t").alias("c")).collect()
    for row, t in zip(got, texts):
        assert row.s == t.strip()
        assert row.k == words(t)
        assert row.c in {ln.strip() for ln in t.split("\n")} | {t.strip().replace("`", "").strip()}


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=10))
def test_f1_symmetric(spark, pairs):
    a = score_rows(spark, pairs)
    b = score_rows(spark, [(g, p) for p, g in pairs])
    for x, y in zip(a, b):
        assert math.isclose(x.f1, y.f1, abs_tol=1e-12)


@settings(max_examples=15, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=20))
def test_invariants_em_implies_perfect_and_clean_is_one_line(spark, texts):
    pairs = [(t, t.upper().replace("ß", "ß")) for t in texts]  # same text, other case
    for row, (p, _) in zip(score_rows(spark, pairs), pairs):
        if row.em == 1.0 and words(p) and words(p) == words(p.upper()):
            assert row.f1 == 1.0 and row.bleu4 == 1.0
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, row in zip(texts, df.select(clean_command("t").alias("c")).collect()):
        survivors = [ln.strip() for ln in t.strip().split("\n")
                     if ln.strip() and not ln.strip().startswith(("```", "#"))]
        if survivors:
            assert "\n" not in row.c


def test_multiset_overlap_equals_counters(spark):
    import random
    from collections import Counter
    rng = random.Random(4)
    bag = lambda: [rng.choice([-(1 << 63), 7, 7, 1 << 40, 8, (1 << 63) - 2, rng.randrange(4, 40) * 2])
                   for _ in range(rng.choice([0, 1, 5, 60]))]
    rows = [(i, bag(), bag()) for i in range(300)]
    got = spark.createDataFrame(rows, "i int, p array<bigint>, g array<bigint>").select("i", multiset_overlap("p", "g").alias("m"))
    want = {i: sum((Counter(p) & Counter(g)).values()) for i, p, g in rows}
    assert {r.i: r.m for r in got.collect()} == want


def test_round_exact_is_pythons_round(spark):
    xs = [i / 1000 for i in range(-10_000, 10_000)] + [0.125, 2.675, 1e15 + 0.3, 2.0**52 - 0.5, 5e-324, 1e300]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    for r in df.select("x", *[round_exact(F.col("x"), k).alias(f"r{k}") for k in (0, 1, 2, 3, 6)]).collect():
        assert [r[f"r{k}"] for k in (0, 1, 2, 3, 6)] == [round(r.x, k) for k in (0, 1, 2, 3, 6)], r.x
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,)], "x double").select(round_exact(F.col("x"), 2).alias("r"))
    assert [str(r.r) for r in odd.collect()] == ["nan", "inf", "None"]


def test_plain_numbers_print_as_in_python(spark):
    xs = [12345678.0, 0.0001, 50.0, 1e7, 0.00012345, 123456789.25, -1e8, 0.0, 9.99, -0.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    assert [r.t for r in df.select(plain_number(F.col("x")).alias("t")).collect()] == [repr(x) for x in xs]


def test_words_are_pythons_words(spark):
    """Every character below U+30000 between two letters."""
    cs = [c for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, f"x{chr(c)}y") for c in cs], "c int, t string").repartition(8)
    got = {r.c: r.k for r in df.select("c", F.regexp_extract_all("t", F.lit(TOKEN_PATTERN_JAVA), 0).alias("k")).collect()}
    assert [hex(c) for c in cs if got[c] != re.findall(r"\w+|[^\w\s]", f"x{chr(c)}y")] == []


def test_exact_sums_ignore_the_partitioning(spark):
    import random
    from fractions import Fraction
    rng = random.Random(9)
    xs = [rng.choice([1.0, 0.1, 1 / 3, rng.random(), 1e-9]) for _ in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    sums = {df.repartition(n, "i").agg(exact_sum(F.col("x"), 53).alias("s")).collect()[0].s for n in (1, 7, 200)}
    assert len(sums) == 1 and abs(Fraction(sums.pop()) - sum(map(Fraction, xs))) < Fraction(1, 10**10)
    assert df.where("i < 0").agg(exact_sum(F.col("x"), 53).alias("s")).collect()[0].s is None
