"""The n-gram join where many sets share signatures, with repeated and null ids, and what its sketches promise."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from cmdeval.llm import ngram_join


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set()


def components(rows):
    """Smallest id (null last) that links lead to, a value for each row."""
    sets = [shingles(t) for _, t in rows]
    part = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]) and part[i] != part[j]:
            old, new = part[j], part[i]
            part = [new if p == old else p for p in part]
    low = {p: min((r[0] for r, q in zip(rows, part) if q == p and r[0] is not None), default=None) for p in part}
    return [(r[0], len(s), low[p] if s else r[0]) for r, s, p in zip(rows, sets, part)]


def test_shared_passages_and_odd_ids(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)  # buckets fall into many blocks
    rng = np.random.default_rng(2)
    passage = [f"p{i}" for i in range(90)]
    texts = []
    for g in range(14):  # documents that share a passage; some are near copies of each other
        own = [f"g{g}_{i}" for i in range(int(rng.integers(10, 60)))]
        for _ in range(4):
            w = passage + own
            for k in rng.integers(0, len(w), size=rng.integers(0, 5)):
                w[k] = f"z{rng.integers(10 ** 6)}"
            texts.append(" ".join(w))
    rows = list(enumerate(texts)) + [(None, texts[5]), (None, "alone in the world with no id"), (3, texts[3]), (3, "other text of a repeated id"),
                                     (500, "x\ty\x0bz"), (501, "X y Z"), (502, "y z"), (503, None), (504, " \n "), (505, "long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("name", F.lit("clash")).repartition(6)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(df).collect()]
    assert sorted(got, key=str) == sorted(components(rows), key=str)


def test_sketches_never_hide_a_link():
    rng = np.random.default_rng(4)
    for n in (1, 3, 40, 700, 1500, 5000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 2 ** 63, size=n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) > 0.06], rng.integers(0, 2 ** 63, size=n // 20, dtype=np.uint64)]))
            if not len(b):
                continue
            common = len(np.intersect1d(a, b))
            x, y = ngram_join.sketch(a), ngram_join.sketch(b)
            words = min(len(x), len(y))
            may = ngram_join.may_link(len(a), ngram_join.folded(x, words), np.array([len(b)]), ngram_join.folded(y, words)[None, :], 85)[0]
            assert may or 100 * common < 85 * (len(a) + len(b) - common)
    far = ngram_join.sketch(np.arange(500, dtype=np.uint64)), ngram_join.sketch(np.arange(9000, 9500, dtype=np.uint64))
    assert not ngram_join.may_link(500, far[0], np.array([500]), far[1][None, :], 85)[0]


def test_pairs_across_components_grow_with_the_classes(spark, monkeypatch):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):  # each links with many of the others, not with all
        w = list(base)
        for k in rng.integers(0, len(w), size=8):
            w[k] = f"z{rng.integers(10 ** 6)}"
        rows.append((i, " ".join(w)))
    made = {}
    real = ngram_join.materialise

    def counted(df, name, *rest):
        out = real(df, name, *rest)
        made[name] = out.count()
        return out

    monkeypatch.setattr(ngram_join, "materialise", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_components(df).collect()]
    assert sorted(got) == sorted(components(rows))
    assert all(n <= ngram_join.FEW * len(rows) for name, n in made.items() if "across" in name or "second" in name), made
