"""The fair queue against a service simulated event by event, with awkward rows."""

import hashlib
from collections import defaultdict
from fractions import Fraction

from cmdeval.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, taken string, _finish string"
ROWS = ([(i, "w " * (1 + i * 7 % 23), "ab"[i % 2], "x", "y") for i in range(60)]
        + [(None, "w w w", "a", "x", "y"), (None, "w w w w", None, "x", "y"), (70, None, "b", "x", "y"), (71, "", "c", "x", "y")]
        + [(72, "r r r r r", "c", "x", "y")] * 3 + [(73, "long " * 900, "d", "x", "y")])


def served(seed, share, weights):
    """Words taken of each (source, doc_id, size), the queues served at the same time until the budget is spent."""
    queues = defaultdict(list)
    for doc_id, text, source, *_ in ROWS:
        key = hashlib.md5(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        if text and text.split():
            queues[source].append((key, doc_id is not None, doc_id or 0, len(text.split())))
    names = sorted(queues, key=lambda s: (s is None, s or ""))
    left, got = {}, {}
    for i, s in enumerate(names):
        left[s] = [q for _ in range(2) for q in sorted(queues[s])]
        got[s] = [Fraction(0)] * len(left[s])
    rate = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget = Fraction(share) * sum(q[3] for s in names for q in queues[s])
    at = dict.fromkeys(names, 0)
    while budget > 0 and (active := [s for s in names if at[s] < len(left[s])]):
        rest = {s: left[s][at[s]][3] - got[s][at[s]] for s in active}
        step = min([rest[s] / rate[s] for s in active] + [budget / sum(rate[s] for s in active)])
        for s in active:
            got[s][at[s]] += step * rate[s]
            budget -= step * rate[s]
            at[s] += got[s][at[s]] == left[s][at[s]][3]
    out = defaultdict(list)
    for s in names:
        n = len(left[s]) // 2
        for (_, known, doc_id, size), a, b in zip(left[s], got[s][:n], got[s][n:]):
            out[(s, doc_id if known else None, size)].append(int(a + Fraction(1, 2)) + int(b + Fraction(1, 2)))
    return {k: sorted(v) for k, v in out.items()}


def taken(df, **kw):
    out = defaultdict(list)
    for r in mixing.mix(df, **kw).collect():
        if r["size"]:
            out[(r.source, r.doc_id, r["size"])].append(r.taken)
        else:
            assert r.taken == 0
    return {k: sorted(v) for k, v in out.items()}


def test_queue_serves_as_simulated(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5)
    for share, weights, seed in ((1.5, (5, 2, 1), "mix"), (0.4, (5, 2, 1), "other"), (1.1, (1, 1), "mix"), (2.5, (5, 2, 1), "mix")):
        assert taken(df, share=share, weights=weights, seed=seed) == served(seed, share, weights)


def test_order_decides_which_documents_are_taken(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, SCHEMA)
    want = taken(df, share=0.4)
    assert taken(df, share=0.4, seed="another") != want
    sums = mixing.prefix_sums

    def unsorted(df, order, values, name):
        return sums(df, order[::-1] if name == "mix-served" else order, values, name)
    monkeypatch.setattr(mixing, "prefix_sums", unsorted)
    assert taken(df) != served("mix", 1.5, (5, 2, 1))
