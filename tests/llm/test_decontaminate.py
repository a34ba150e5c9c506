"""Benchmark passages in documents, against a word-by-word search."""

import random
import re

import pytest

from cmdeval.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n):
    pats = {}
    for item, t in items:
        w = words(t)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            pats.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(p) for p in pats}:
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in pats:
                    hit |= set(range(i, i + k))
                    found |= pats[tuple(w[i:i + k])]
        out.append((doc, len(w), tuple(sorted(hit)), tuple(sorted(x for x in found if x is not None))))
    return sorted(out, key=repr)


def found(rows):
    return sorted(((r.doc_id, r.n_words, tuple(i for s in r.spans for i in range(s.start, s.end)), tuple(r["items"]))
                   for r in rows), key=repr)


@pytest.mark.parametrize("block_pairs", [1 << 17, 7])
def test_equals_word_by_word_search(spark, block_pairs):
    rng = random.Random(5)
    vocabulary = ["a", "b", "ab", "Ba", "x1", "é", "中文", "zz-top", "long" * 30, "12"]
    text = lambda k: rng.choice([" ", ", ", "\x00", "\n"]).join(rng.choice(vocabulary) for _ in range(k))
    items = [(str(i % 9), text(rng.choice([1, 3, 4, 5, 9]))) for i in range(12)]
    items += [(None, "null id here"), ("e", ""), ("n", None), ("p", ". , !"), ("big", "w " * 300)]
    docs = [(i, text(rng.choice([0, 2, 30]))) for i in range(150)]
    docs += [(None, "a null id here a"), (150, None), (151, ""), (152, "w " * 5000), (153, items[0][1]), (153, items[0][1])]
    got = decontaminate.find_passages(spark.createDataFrame(docs, "doc_id bigint, text string"),
                                      spark.createDataFrame(items, "item_id string, text string"), n=4, block_pairs=block_pairs)
    assert found(got.collect()) == brute(docs, items, 4)


def test_long_text_overlapping_and_touching_passages(spark):
    passage = " ".join(f"w{i}" for i in range(14))
    long = "lorem ipsum " * 60_000
    docs = [(1, f"{long}{passage.upper()}. {passage} {long}"), (2, f"x{passage}"), (3, passage.rsplit(" ", 5)[0])]
    got = {r.doc_id: r for r in decontaminate.find_passages(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame([(7, passage), (8, passage)], "item_id bigint, text string")).collect()}
    assert [(s.start, s.end) for s in got[1].spans] == [(120_000, 120_028)] and got[1]["items"] == ["7", "8"]
    assert [(s.start, s.end) for s in got[2].spans] == [(1, 14)]
    assert got[3].spans == []


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "one two", "kept", "gone")], "doc_id bigint, text string, item string, N_Words string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    row = decontaminate.find_passages(docs, none).collect()[0]
    assert (row.doc_id, row.text, row.item, row.n_words, row.spans, row["items"]) == (1, "one two", "kept", 2, [], [])
    assert decontaminate.find_passages(docs.where("doc_id = 2"), none).count() == 0
