"""Evaluation inputs derived from the shared test tables.

All derivations are narrow projections or a key-unique self join, so they
scale with the tables they read:

* pairs      - each ``user`` turn whose next turn is ``assistant``
* suite      - one row per document: even ids in ``suite_a``, odd in
               ``suite_b``; gold = the whole text on one line, stripped
* answers    - of two models, ``base`` and ``tuned``, to every row, in five
               shapes (plain, fenced, chatty, commented, half)
* responses  - the answers as a predictor logs them: none when ``doc_id % 11
               = 0``, only a failed call when ``doc_id % 17 = 0``, a failed
               call before the answer when ``doc_id % 13 = 0``
* run log / GPU samples - ``events`` read as telemetry
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COMMAND_ALIASES, IM_END, IM_START, INSTRUCTION_ALIASES
from ..functions.text import _col, strip


# Fixture parameters (shared with the SQL in plans/oracle.py).
SIM_MODELS = ("base", "tuned")
SIM_MISSING_MOD = 11
SIM_RETRY_MOD = 13
SIM_FAILED_MOD = 17
SIM_CUT_MOD, SIM_CUT_REST = 23, 5
SIM_FLAVOURS = 5
SIM_TUNED_KEEP_MOD = 3
SIM_LATENCY_STEP = 0.25
SIM_LATENCY_MOD = 7
SIM_LATENCY_BASE = {"base": 2.0, "tuned": 0.5}
CHATTER = "Hope this helps."
COMMENT_LINE = "# note"
GPU_TOTAL_GIB = 512


def pair_id(conv: str, turn: str) -> Column:
    """Id of a turn pair: the first 15 hexadecimal digits of an MD5, so long conversations don't collide."""
    digest = F.md5(F.concat_ws(":", F.col(conv).cast("string"), F.col(turn).cast("string")))
    return F.conv(F.left(digest, F.lit(15)), 16, 10).cast("bigint")


def conversation_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, conv_id, turn, instruction, command) from chat turns.

    An equi-join on (conv_id, turn + 1): its key is unique, so a very long
    conversation spreads over many tasks instead of landing in one window
    partition.
    """
    user = (conversations.where(F.col("role") == "user")
            .select("conv_id", "turn", F.col("text").alias("instruction")))
    asst = (conversations.where(F.col("role") == "assistant")
            .select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("command")))
    return (user.join(asst, ["conv_id", "turn"], "inner")
            .select(pair_id("conv_id", "turn").alias("pair_id"),
                    "conv_id", "turn", "instruction", "command"))


def gold_of(text: Column | str) -> Column:
    """Reference command of a text: the whole text on one line, stripped."""
    return strip(F.replace(_col(text), F.lit("\n"), F.lit(" ")))


def suite_from_documents(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.when(F.col("doc_id") % 2 == 0, F.lit("suite_a")).otherwise(F.lit("suite_b")).alias("suite"),
        F.col("doc_id").alias("id"),
        F.col("text").alias("nl"),
        gold_of("text").alias("gold"),
    )


def _flavour_text(flavour: Column, gold: Column) -> Column:
    return (F.when(flavour == 0, gold)
            .when(flavour == 1, F.concat(F.lit("```bash\n"), gold, F.lit("\n```")))
            .when(flavour == 2, F.concat(gold, F.lit("\n" + CHATTER)))
            .when(flavour == 3, F.concat(F.lit(COMMENT_LINE + "\n"), F.replace(gold, F.lit("e"), F.lit("E"))))
            .otherwise(F.left(gold, F.floor(F.length(gold) / 2).cast("int"))))


def simulated_answers(suite: DataFrame) -> DataFrame:
    """(model, suite, id, raw_prediction, latency) of both simulated models for every suite row.

    The two model rows come from exploding a literal array: no join.
    """
    models = F.array(*[F.lit(m) for m in SIM_MODELS])
    rows = suite.withColumn("model", F.explode(models))
    flavour = (F.when(F.col("model") == "base", F.col("id") % SIM_FLAVOURS)
               .when(F.col("id") % SIM_TUNED_KEEP_MOD == 0, F.col("id") % SIM_FLAVOURS)
               .otherwise(F.lit(0)))
    base_latency = (F.when(F.col("model") == "base", F.lit(SIM_LATENCY_BASE["base"]))
                    .otherwise(F.lit(SIM_LATENCY_BASE["tuned"])))
    return rows.select(
        "model", "suite", "id",
        _flavour_text(flavour, F.col("gold")).alias("raw_prediction"),
        (F.lit(SIM_LATENCY_STEP) * (F.col("id") % SIM_LATENCY_MOD) + base_latency).alias("latency"),
    )


def simulated_responses(suite: DataFrame) -> DataFrame:
    """(model, suite, id, raw_prediction, latency, is_error, ts): the answers with missing, failed and retried calls."""
    calls = with_arrival_time(simulated_answers(suite)).where(F.col("id") % SIM_MISSING_MOD != 0)
    kinds = (F.when(F.col("id") % SIM_FAILED_MOD == 0, F.array(F.lit(True)))
             .when(F.col("id") % SIM_RETRY_MOD == 0, F.array(F.lit(True), F.lit(False)))
             .otherwise(F.array(F.lit(False))))
    calls = calls.withColumn("is_error", F.explode(kinds))
    failed = F.col("is_error")
    return calls.select(
        "model", "suite", "id",
        F.when(failed, F.lit("")).otherwise(F.col("raw_prediction")).alias("raw_prediction"),
        F.when(failed, F.lit(0.0)).otherwise(F.col("latency")).alias("latency"), "is_error",
        F.when(failed, F.col("ts") - F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts")).alias("ts"))


def response_dump(suite: DataFrame) -> DataFrame:
    """The predictor's log as lines of JSON: failed calls flagged (odd ids) or as an error's body (even ids), and of
    the answers with ``id % 23 = 5`` only a line that was cut off."""
    calls = simulated_responses(suite)
    key = ["model", "suite", "id"]
    answer = F.to_json(F.struct(*key, "raw_prediction", "latency", "ts"))
    flagged = F.to_json(F.struct(*key, "raw_prediction", "latency", "is_error", "ts"))
    body = F.to_json(F.struct(*key, F.lit("timeout").alias("error"), "ts"))
    cut = F.left(answer, F.length(answer) - 1)
    return calls.select(F.when(F.col("is_error") & (F.col("id") % 2 == 0), body).when(F.col("is_error"), flagged)
                        .when(F.col("id") % SIM_CUT_MOD == SIM_CUT_REST, cut).otherwise(answer).alias("value"))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """Training pairs as lines of JSON, under each of the accepted names in turn."""
    k = F.col("pair_id") % len(INSTRUCTION_ALIASES)
    line = F.lit(None).cast("string")
    for i, (a, b) in enumerate(zip(INSTRUCTION_ALIASES, reversed(COMMAND_ALIASES))):
        line = F.when(k == i, F.to_json(F.struct("pair_id", F.col("instruction").alias(a), F.col("command").alias(b)))).otherwise(line)
    return pairs.select(line.alias("value"))


def generations(responses: DataFrame) -> DataFrame:
    """Raw generations that run past the answer: by ``id % 3`` nothing, an
    end-of-turn marker and chatter, or a new turn header and the gold."""
    k = F.col("id") % 3
    tail = (F.when(k == 1, F.concat(F.lit(IM_END + "\n"), F.lit(CHATTER)))
            .when(k == 2, F.concat(F.lit(IM_START + "assistant\n"), F.col("raw_prediction")))
            .otherwise(F.lit("")))
    return responses.withColumn("generation", F.concat(F.col("raw_prediction"), tail))


def with_arrival_time(responses: DataFrame) -> DataFrame:
    """Responses with a deterministic arrival time (one second per id)."""
    return responses.withColumn(
        "ts", F.timestamp_seconds(F.lit(1704067200) + F.col("id")))


def run_log_from_events(events: DataFrame) -> DataFrame:
    return events.select(F.col("user_id").cast("string").alias("run_id"),
                         F.col("event_id").alias("step"), "ts",
                         F.col("value").alias("loss"))


def gpu_samples_from_events(events: DataFrame) -> DataFrame:
    gib = float(1 << 30)
    return events.select(
        F.col("user_id").cast("string").alias("run_id"), "ts",
        F.col("event_type").alias("label"),
        F.round(F.col("value") * F.lit(gib)).cast("bigint").alias("reserved_bytes"),
        F.lit(GPU_TOTAL_GIB * (1 << 30)).cast("bigint").alias("total_bytes"),
    )
