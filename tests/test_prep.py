import pytest
from pyspark.sql import functions as F

from cmdeval.constants import SYSTEM_PROMPT
from cmdeval.operators import prep

S = "<|im_start|>system\n" + SYSTEM_PROMPT + "<|im_end|>\n"


@pytest.mark.parametrize("icol,ccol", [("prompt", "completion"), ("instruction", "command"),
                                       ("input", "output"), ("question", "response")])
def test_alias_variants(spark, icol, ccol):
    df = spark.createDataFrame([(1, "\t list files ", "ls -la\r\n")], f"pair_id long, {icol} string, {ccol} string")
    assert prep.resolve_pairs(df).collect()[0].asDict() == {"pair_id": 1, "instruction": "list files",
                                                            "command": "ls -la"}


def test_alias_priority_nulls_and_missing(spark):
    df = spark.createDataFrame([(1, "p", "i", "c"), (2, None, "i2", "c2")],
                               "pair_id long, input string, prompt string, completion string")
    got = {r.pair_id: r.instruction for r in prep.resolve_pairs(df).collect()}
    assert got == {1: "i", 2: "i2"}  # prompt wins over input
    df2 = spark.createDataFrame([(1, "p", None)], "pair_id long, prompt string, completion string")
    assert prep.resolve_pairs(df2).count() == 0
    assert prep.resolve_pairs(df2, null_as_text=True).collect()[0].command == "None"
    with pytest.raises(ValueError):
        prep.resolve_pairs(spark.createDataFrame([(1, "x")], "pair_id long, text string"))


def test_render_training_and_prompt(spark):
    df = spark.createDataFrame([(1, "list files", "ls")], "pair_id long, instruction string, command string")
    text = prep.render_training(df).collect()[0].text
    assert text == S + "<|im_start|>user\nlist files<|im_end|>\n<|im_start|>assistant\nls<|im_end|>\n"
    p = prep.render_prompt(df).collect()[0].prompt
    assert p == S + "<|im_start|>user\nlist files<|im_end|>\n<|im_start|>assistant\n"
    empty = spark.createDataFrame([("",)], "instruction string")
    assert prep.render_prompt(empty, system="").collect()[0].prompt == "<|im_start|>assistant\n"


def test_render_conversations_orders_across_chunks(spark):
    rows = [(7, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in reversed(range(9))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = prep.render_conversations(df, chunk_turns=2).collect()[0]
    expect = "".join(f"<|im_start|>{'user' if t % 2 == 0 else 'assistant'}\nm{t}<|im_end|>\n" for t in range(9))
    assert out.n_turns == 9 and out.text == expect


def test_truncate_tokens(spark):
    df = spark.createDataFrame([("a b c d e",)], "text string")
    r = prep.truncate_tokens(df, budget=3).collect()[0]
    assert (r.n_tokens, r.kept_tokens, r.over_budget) == (5, ["a", "b", "c"], True)


def test_training_plan_bounded_and_deterministic(spark):
    df = spark.range(100).withColumnRenamed("id", "pair_id")
    plan = prep.training_plan(df, rows_per_step=4, max_steps=5)
    rows = plan.orderBy("rank").collect()
    assert len(rows) == 20 and [r.rank for r in rows] == list(range(1, 21))
    assert [r.step for r in rows] == [i // 4 + 1 for i in range(20)]
    keys = [r.order_key for r in rows]
    assert keys == sorted(keys)
    assert [r.pair_id for r in rows] == [r.pair_id for r in prep.training_plan(df, rows_per_step=4, max_steps=5)
                                         .orderBy("rank").collect()]
    # the first rows are the smallest md5 keys over the whole input
    allk = sorted(r.k for r in df.select(F.md5(F.concat(F.lit("3407:"), F.col("pair_id").cast("string"))).alias("k"))
                  .collect())
    assert keys == allk[:20]


def test_map_batches(spark):
    def _upper_commands(batch):  # local, so it is pickled by value
        return {"pair_id": batch["pair_id"], "text": [c.upper() for c in batch["command"]]}

    df = spark.createDataFrame([(i, f"ls {i}") for i in range(50)], "pair_id long, command string")
    got = {r.pair_id: r.text for r in prep.map_batches(df, _upper_commands, "pair_id long, text string").collect()}
    assert len(got) == 50 and got[7] == "LS 7"


def test_training_plan_from_config(spark):
    from cmdeval.config import TrainConfig
    cfg = TrainConfig(batch_size=2, grad_accum_steps=2, max_steps=3)
    assert (cfg.rows_per_step, cfg.rows_used) == (4, 12)
    df = spark.range(50).withColumnRenamed("id", "pair_id")
    rows = prep.training_plan(df, config=cfg).collect()
    assert len(rows) == 12 and max(r.step for r in rows) == 3
    assert TrainConfig().rows_used == 4800 and TrainConfig().max_seq_length == 2048
