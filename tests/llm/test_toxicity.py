"""Toxicity by nearest labelled examples, against vectors and votes worked out word by word."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cmdeval.llm import toxicity


def brute(docs, labels):
    """(vote, nearest ids, cosines) of each text, from all pairs of texts and examples."""
    toxic = {}
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            toxic[i] = max(toxic.get(i, 0), y)
    examples = {}
    for i, t in sorted((d for d in docs if d[0] in toxic), key=lambda d: d[0]):
        if t is not None and len(t) <= toxicity.EXAMPLE_CHARS:
            examples.setdefault(t, (i, toxic[i]))
    bag = {t: Counter(w for w in (x.strip(toxicity._EDGE) for x in (t or "").lower().split()) if w) for _, t in docs}
    df = Counter(w for _, t in docs for w in bag[t])
    n1 = sum(y for _, y in examples.values())
    n0 = len(examples) - n1

    def factor(w):
        held = [y for t, (_, y) in examples.items() if w in bag[t]]
        if not held:
            return math.log((1 + len(docs)) / 2)
        a, b = sum(held), len(held) - sum(held)
        rate = len(held) / len(examples)
        z = abs(a / n1 - b / n0) / math.sqrt(rate * (1 - rate) * (1 / n1 + 1 / n0) + 1e-12)
        odds = abs(math.log((a + 0.5) / (n1 + 1) / ((b + 0.5) / (n0 + 1))))
        return math.log((1 + len(docs)) / (1 + df[w])) * (1 + max(z - 3, 0) * odds)

    weights = {w: factor(w) for w in df}
    vectors = {}
    for t, words in bag.items():
        v = {w: (1 + math.log(k)) * weights[w] for w, k in words.items()}
        length = math.sqrt(sum(x * x for x in v.values()))
        vectors[t] = {w: x / length for w, x in v.items()} if length else {}
    out = {}
    for i, t in docs:
        near = [(-sum(x * vectors[e].get(w, 0.0) for w, x in vectors[t].items()), j, y) for e, (j, y) in examples.items()]
        near = sorted(x for x in near if x[0] < -1e-12)[:toxicity.NEIGHBOURS]
        yes, every = -sum(s for s, _, y in near if y), -sum(s for s, _, _ in near)
        vote = math.log((yes + 0.05) / (every - yes + 0.05)) if near else None
        out[i, t] = vote, [j for _, j, _ in near], [-s for s, _, _ in near]
    return out


@pytest.mark.parametrize("block", [4, 64])
def test_votes_and_evidence_are_those_of_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(toxicity, "BLOCK", block)
    monkeypatch.setattr(toxicity, "FIRST_BLOCKS", 1)
    monkeypatch.setattr(toxicity, "EXAMPLE_CHARS", 400)
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(120)]

    def text(bad):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(120)], k=rng.randint(3, 25))
        return " ".join(words + rng.choices(["swine", "fool,"], k=2 * bad) + [f"Own{rng.randint(0, 900)}."])

    docs = [(i, text(i % 4 == 0)) for i in range(160)]
    docs += [(200, None), (201, ""), (202, " ., "), (203, "words of nobody"), (204, "swine " * 500),
             (205, docs[8][1]), (None, docs[8][1]), docs[9], (206, docs[9][1])]
    labels = [(i, int(i % 4 == 0)) for i in range(160)] + [(0, 0), (1, None), (None, 1), (203, 0), (204, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    lf = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    index = toxicity.fit(df, lf)
    want = brute(docs, labels)
    got = toxicity.score(df, lf).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == sorted((str(i), str(t)) for i, t in docs)
    for r in got:
        vote, ids, cosines = want[r.doc_id, r.text]
        p = index.none if vote is None else 1 / (1 + math.exp(-(index.slope * vote + index.offset)))
        assert r.score == pytest.approx(p, abs=1e-9) and r.predicted == int(r.score >= 0.7)
        assert [e.cosine for e in r.evidence] == pytest.approx(cosines[:3], abs=1e-9)
        for e in r.evidence:  # equal cosines may come in either order
            assert want[r.doc_id, r.text][2][ids.index(e.doc_id)] == pytest.approx(e.cosine, abs=1e-9)
    assert 204 not in {e.doc_id for r in got for e in r.evidence}  # too long for an example, scored all the same
    assert next(r for r in got if r.doc_id == 204).predicted == 1


def test_calibration_uses_votes_of_the_other_examples(spark):
    """An example doesn't vote for itself: labels at random teach that neighbours tell nothing."""
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices([f"v{k}" for k in range(60)], k=12))) for i in range(400)]
    labels = [(i, int(rng.random() < 0.3)) for i, _ in rows]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string"),
                         spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()
    assert np.mean([r.predicted for r in got]) < 0.1


def test_null_id_is_not_held_out(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "doc_id bigint, text string")
    got = {r.doc_id: r.h for r in df.select("doc_id", toxicity.held_out("doc_id").alias("h")).collect()}
    assert got == {None: False, 1: zlib.crc32(b"1") % 3 == 1}
