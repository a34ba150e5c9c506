"""Bags matched and counted in Arrow batches, against Python's own counters and the column expressions."""

import random
import re
from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
from cmdeval.constants import TOKEN_PATTERN_PYTHON
from cmdeval.functions.text import tokens
from cmdeval.operators import bags, evaluate, scoring, syntax

ROWS = "id long, clean_prediction string, gold string"


def grams(text, n):
    words = re.findall(TOKEN_PATTERN_PYTHON, text or "")
    return Counter(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))


def texts():
    rnd = random.Random(5)

    def one():
        return rnd.choice([None, "", " ", *[" ".join(rnd.choices("ab;cé", k=rnd.choice([1, 2, 3, 4, 9, 300]))) for _ in range(9)]])
    return [(i, one(), one()) for i in range(300)] + [(300, "a b " * 30_000, "b a " * 20_000)]


def test_matches_are_those_of_counters():
    rows = texts()
    got = bags.matched(pa.array([p for _, p, _ in rows], pa.string()), pa.array([g for *_, g in rows], pa.string())).to_pylist()
    for (_, p, g), found in zip(rows, got):
        assert found == [sum(grams(p, 1).values()), sum(grams(g, 1).values()),
                         *[sum((grams(p, n) & grams(g, n)).values()) for n in range(1, 5)]]
    assert bags.matched(pa.array([], pa.string()), pa.array([], pa.string())).to_pylist() == []


def test_batches_score_like_columns(spark):
    df = spark.createDataFrame(texts(), ROWS)
    assert (sorted(map(repr, scoring.score_pairs(df, batches=True).collect()))
            == sorted(map(repr, scoring.score_pairs(df).collect())))
    short = scoring.score_pairs(df, batches=True, bleu=False)
    assert "bleu4" not in short.columns
    assert sorted(map(repr, short.collect())) == sorted(map(repr, scoring.score_pairs(df).drop("bleu4").collect()))


def test_scoring_in_batches_adds_no_exchange(spark):
    p = scoring.score_pairs(spark.createDataFrame(texts()[:3], ROWS), batches=True)._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in p and "Exchange" not in p


def test_token_counts_are_counted_in_batches(spark):
    rows = texts()[:120]
    df = scoring.token_counts(spark.createDataFrame(rows, ROWS), ["id"])
    got = {(r.id, r.side, r.n, r.gram): r.cnt for r in df.collect()}
    assert got == {(i, side, n, g): c for i, *both in rows for side, t in zip(("pred", "gold"), both)
                   for n in range(1, 5) for g, c in grams(t, n).items()}
    assert "MapInArrow" in df._jdf.queryExecution().executedPlan().toString()


def test_both_patterns_cut_the_same_tokens(spark):
    chars = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    lines = [" ".join(f"a{c}b {c}" for c in chars[i:i + 500]) for i in range(0, len(chars), 500)]
    df = spark.createDataFrame([(x,) for x in lines], "t string").select(bags.prepared("t").alias("t"), tokens("t").alias("k"))
    for r in df.collect():
        assert re.findall(TOKEN_PATTERN_PYTHON, r.t) == r.k


def evaluation(spark):
    suite = spark.createDataFrame([("s", i, "q", f"ls {i}") for i in range(600)], "suite string, id long, nl string, gold string")
    calls = suite.selectExpr("'m' AS model", "suite", "id", "gold AS raw_prediction", "1.0D AS latency")
    return suite, calls


def test_syntax_join_takes_no_text_as_key(spark):
    suite, calls = evaluation(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = evaluate.summarise(evaluate.score(suite, calls, ["m"], check_syntax=True))
        p = df._jdf.queryExecution().executedPlan().toString()
        r = df.first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(_key" in p and "hashpartitioning(clean_prediction" not in p
    assert (r.num_samples, r.exact_match_pct, r.syntax_validity_pct) == (600, 100.0, 100.0)


def test_syntax_worker_holds_few_commands():
    batch = pa.RecordBatch.from_arrays([pa.array([f"echo {i}" if i % 5 else "echo (" for i in range(600)])], names=["_cmd"])
    out = list(syntax._check_batches(iter([batch]), 2.0, 4))
    assert max(b.num_rows for b in out) <= syntax.SLICE_COMMANDS < 600
    assert [ok for b in out for ok in b.column(1).to_pylist()] == [i % 5 > 0 for i in range(600)]


def test_tokens_are_cut_from_bytes_as_the_pattern_cuts_them():
    rnd = random.Random(7)
    pool = list("aZ_9 \t\n.-;é日😀") + ["\x1c", "\x85", "\xa0", "　", "½", "́", "\x00", "𝒜", "\U0010ffff", "ª"]
    for k in range(300):
        rows = [rnd.choice([None, "", "".join(rnd.choices(pool if k % 3 else pool[:11], k=rnd.choice([1, 3, 40])))])
                for _ in range(rnd.randint(0, 7))]
        cut = pa.array(["x", *rows, "y"], pa.large_string() if k % 2 else pa.string()).slice(1, len(rows))
        found, sizes = bags._tokens(cut)
        want = [re.findall(TOKEN_PATTERN_PYTHON, t or "") for t in rows]
        assert found.to_pylist() == [w for x in want for w in x] and sizes.tolist() == [len(x) for x in want]


def test_texts_are_lower_cased_once(spark):
    rows = [(1, "\t ΑΣ \n", "ας"), (2, " İx", "i̇X "), (3, None, ""), (4, "a", None), (5, "　B", "b")]
    df = spark.createDataFrame(rows, ROWS)
    scored = scoring.score_pairs(df, batches=True)
    assert [r.em for r in scored.orderBy("id").collect()] == [r.em for r in scoring.score_pairs(df).orderBy("id").collect()]
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lower(") == 2


def test_counts_of_like_texts_stand_together():
    """The models' answers to a sample and its reference hold the same grams: side by side these take less disk."""
    rnd = random.Random(11)
    words = ["".join(rnd.choices("abcdefghijklmnop", k=7)) for _ in range(3000)]
    rows = []
    for i in range(12):
        gold = rnd.choices(words, k=700)
        rows += [("base", i, " ".join(gold[:500]), " ".join(gold)), ("tuned", i, " ".join(["so"] + gold), " ".join(gold))]
    batch = pa.RecordBatch.from_pylist([dict(zip(("model", "id", "p", "g"), r)) for r in rows])
    found = pa.Table.from_batches(bags.counter(["model", "id"], {"p": "pred", "g": "gold"})(iter([batch])))
    assert Counter(found["gram"].to_pylist()) == Counter(g for *_, p, q in rows for t in (p, q) for n in range(1, 5) for g in grams(t, n))

    def held(table):
        sink = pa.BufferOutputStream()
        pq.write_table(table, sink, compression="snappy", use_dictionary=["model", "side", "id", "n"])
        return sink.getvalue().size
    apart = found.sort_by([("side", "descending"), ("n", "ascending"), ("id", "ascending"), ("model", "ascending")])
    assert held(found) < 0.75 * held(apart)


def test_counts_of_one_slice_in_small_batches(monkeypatch):
    rows = [*texts()[:60], (60, "x y x", "x y x"), (60, "x y x", "x y x"), (61, None, None)]
    batch = pa.RecordBatch.from_pylist([{"id": i, "p": p, "g": g} for i, p, g in rows],
                                       pa.schema({"id": pa.int64(), "p": pa.string(), "g": pa.string()}))
    want = Counter((i, side, n, g, c) for i, *both in rows for side, t in zip(("pred", "gold"), both)
                   for n in range(1, 5) for g, c in grams(t, n).items())
    for together, most in ((1 << 16, 1 << 18), (5, 1 << 18), (1 << 16, 7)):
        monkeypatch.setattr(bags, "TOGETHER", together)
        monkeypatch.setattr(bags, "BATCH_ROWS", most)
        out = list(bags.counter(["id"], {"p": "pred", "g": "gold"})(iter([batch, batch.slice(62), batch.slice(0, 0)])))
        assert max(b.num_rows for b in out) <= most
        got = Counter(tuple(r.values()) for b in out for r in b.to_pylist())
        assert got == want
