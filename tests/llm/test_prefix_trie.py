"""The trie of rebuilt conversations against one built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from cmdeval.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(turns)] for c, turns in convs.items()}
    nodes, ends = defaultdict(set), defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt = convs.get(base, [])[:h] + own[h:]
        for d in range(len(rebuilt) + 1):
            nodes[tuple(rebuilt[:d])].add(c)
        ends[tuple(rebuilt)].append(c)
    kids = defaultdict(list)
    for n in nodes:
        if n:
            kids[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[n]) - 1) * len(n[-1][1].encode()) if n else 0
        saved[n] = own + sum(saved[k] for k in kids[n])
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
    return sorted((min(m), len(n), min(nodes[n[:-1]]) if n else -1, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in nodes.items())


def found(df):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in df.collect())


@pytest.mark.parametrize("ranges", [False, True])
def test_equals_trie_built_turn_by_turn(spark, ranges):
    rng = random.Random(3)
    rows = []
    for c in [*range(60), -7, -5, 1003]:
        for t in range(rng.choice([0, 1, 3, 9, 12])):
            rows.append((c, rng.choice([t, t, t, None, 2]), rng.choice(["user", "user", None, ""]), rng.choice(["a", "a", "b", "é", "", None])))
    rows += [(None, 0, "user", "of none"), *rows[:5]]
    if ranges:  # one conversation with most turns, cut by every range
        rows += [(20, i, "user", "x" * (i % 3)) for i in range(600)] + [(21, i, "user", "x" * (i % 3)) for i in range(600)]
        rows += [(22, 5, "user", "same")] * 200
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not ranges).lower())
    try:
        assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_identical_conversations_and_long_text(spark):
    long = "word " * 50_000
    rows = [(5 * c, t, "user", x) for c in range(700) for t, x in enumerate([long[:20] if c else long, "b"])]
    assert found(prefix_trie.build(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(0, 0, "u", "t", 1, 2, 3)], SCHEMA + ", depth int, row int, x1 int")
    assert found(prefix_trie.build(df)) == brute([(0, 0, "u", "t")])
    assert prefix_trie.build(df.where("conv_id = 9")).count() == 0


def test_stored_reference_is_the_turn_that_ends_the_prefix(spark):
    rows = [(c, t, "user", f"{c // 5}-{min(t, 1)}") for c in range(10) for t in range(10)]
    texts = {(c, t + 1): x for c, t, _, x in rows}
    for r in prefix_trie.build(spark.createDataFrame(rows, SCHEMA)).where("depth > 0").collect():
        assert texts[r.ref_conv_id, r.ref_place] == f"{r.conv_id // 5}-{min(r.depth - 1, 1)}"


def test_powers():
    for p, r in zip(prefix_trie.PRIMES, prefix_trie.bases(1)):
        e = np.array([0, 1, 2, 31, 10**12])
        assert prefix_trie.powers(r, e, p).tolist() == [pow(r, int(x), p) for x in e]
