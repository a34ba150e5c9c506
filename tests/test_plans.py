"""Plan-shape checks: the per-pair work stays narrow and JVM-side."""

from cmdeval.operators import evaluate, scoring, telemetry
from cmdeval.plans import catalog
from sf_paths import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_adds_no_exchange_and_no_python(spark):
    df = spark.createDataFrame([(1, "ls -la", "ls")], "id long, clean_prediction string, gold string")
    p = plan(scoring.score_pairs(df))
    assert "Exchange" not in p
    assert "Python" not in p and "ArrowEval" not in p


def test_sim_grid_is_generate_not_join(spark):
    p = plan(catalog.q_eval_grid(spark, SF001))
    assert "Generate" in p and "Join" not in p and "CartesianProduct" not in p


def test_summary_is_partial_then_final_aggregate(spark):
    p = plan(evaluate.summarise(catalog._results(spark, SF001)))
    assert p.count("HashAggregate") >= 2 or "partial" in p.lower()


def test_log_tail_limits_before_shuffle(spark):
    df = telemetry.tail(catalog._run_log(spark, SF001))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in final


def test_scan_prunes_columns(spark):
    p = plan(catalog.q_loss_convergence(spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_suite_text_shuffles_once_per_row(spark):
    """Without broadcast, the suite side is hash-shuffled once (not per model)."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(catalog.q_sample_results(spark, SF001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hashed = [l for l in p.split("\n") if "Exchange hashpartitioning" in l]
    assert len(hashed) == 2  # one per join side
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_token_counts_adds_no_exchange(spark):
    df = spark.createDataFrame([("m", "s", 1, "ls -la", "ls -l")],
                               "model string, suite string, id long, clean_prediction string, gold string")
    p = plan(scoring.token_counts(df, ["model", "suite", "id"]))
    assert "Exchange" not in p and "Aggregate" not in p


def test_token_counts_of_long_and_empty_texts(spark):
    from collections import Counter
    words = (["a", "b", "a", "c"] * 900) + ["z"]
    df = spark.createDataFrame([(1, " ".join(words), ""), (2, "", None)], "id long, clean_prediction string, gold string")
    got = {(r.id, r.side, r.n, r.gram): r.cnt for r in scoring.token_counts(df, ["id"]).collect()}
    want = {(1, "pred", n, " ".join(g)): c for n in range(1, 5)
            for g, c in Counter(tuple(words[i:i + n]) for i in range(len(words) - n + 1)).items()}
    assert got == want


def test_hot_command_key_survives(spark):
    """A command that fills a third of the rows is checked once and joined back whole."""
    from cmdeval.operators import syntax
    rows = [(i, "" if i % 3 == 0 else f"echo {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, cmd string")
    out = syntax.attach(df, syntax.verdicts(df, "cmd", "ok"), "cmd", "ok")
    assert out.count() == 300 and out.where("ok").count() == 300
