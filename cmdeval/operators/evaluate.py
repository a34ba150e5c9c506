"""Evaluation: grid, pairing with answers, per-sample results and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import SCORE_BITS, SECONDS_BITS, exact_sum, output_chars, round_exact, single_line
from ..functions.text import clean_command, strip
from .scoring import score_pairs

KEYS = ["model", "suite", "id"]

RESULT_COLUMNS = ["model", "suite", "id", "nl", "gold", "raw_prediction", "clean_prediction",
                  "em", "f1", "bleu4", "latency", "is_error"]


def grid(suite: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every model against every suite row.

    The model list is the caller's (a bounded literal), so the grid is a
    per-row ``explode``, not a join.
    """
    if not models:
        raise ValueError("models must name at least one model")
    return suite.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def suite_union(*suites: tuple[str, DataFrame]) -> DataFrame:
    """Union of named suites: each (name, DataFrame with id/nl/gold) gets its ``suite`` literal."""
    parts = [df.select(F.lit(name).alias("suite"), "id", "nl", "gold") for name, df in suites]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failed_call(responses: DataFrame) -> Column:
    """Whether a call failed: its ``is_error`` flag, where there is one, or a null text."""
    null = F.col("raw_prediction").isNull()
    return F.coalesce(F.col("is_error"), F.lit(False)) | null if "is_error" in responses.columns else null


def failures(responses: DataFrame) -> DataFrame:
    """(model, suite, reason, n_calls): failed calls of a dump by reason; calls whose key can't be read have null
    model and suite. Combined map-side."""
    reason = F.col("error") if "error" in responses.columns else F.lit("failed")
    return (responses.where(failed_call(responses)).groupBy("model", "suite", reason.alias("reason"))
            .agg(F.count(F.lit(1)).alias("n_calls")))


def pair_with_responses(suite: DataFrame, responses: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every (model, suite row) with its answer; a missing answer becomes ``("", 0.0)``.

    Answers are folded per (suite, id) into one struct column per requested
    model (a single aggregation that combines map-side). Of several calls for
    one key the first that did not fail counts (by arrival time ``ts``, then
    latency and text); the running evaluation keeps the same one. A failed call
    (``is_error``, or a null text) has a blank text and latency 0. The suite joins that once on
    (suite, id) and the models are exploded after the join, so each suite row
    crosses the network once however many models there are. The answer is
    stripped as it is read; ``is_error`` marks the defaults.
    """
    if not models:
        raise ValueError("models must name at least one model")
    models = list(dict.fromkeys(models))
    failed = failed_call(responses)
    arrival = F.col("ts") if "ts" in responses.columns else F.lit(0)
    answer = F.struct(failed.alias("is_error"), arrival.alias("ts"),
                      F.when(failed, F.lit(0.0)).otherwise(F.col("latency").cast("double")).alias("latency"),
                      F.when(failed, F.lit("")).otherwise(F.col("raw_prediction")).alias("raw_prediction"))
    folded = (responses.where(F.col("model").isin(models)).groupBy("suite", "id")
              .agg(*[F.min(F.when(F.col("model") == m, answer)).alias(f"_a{i}") for i, m in enumerate(models)]))
    per_model = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"_a{i}").alias("a"))
                          for i, m in enumerate(models)])
    joined = (suite.join(folded, ["suite", "id"], "left")
              .select("suite", "id", "nl", "gold", F.inline(per_model)))
    return joined.select(
        *KEYS, "nl", "gold",
        F.coalesce(strip(F.col("a.raw_prediction")), F.lit("")).alias("raw_prediction"),
        F.coalesce(F.col("a.latency"), F.lit(0.0)).alias("latency"),
        F.coalesce(F.col("a.is_error"), F.lit(True)).alias("is_error"))


def score(suite: DataFrame, responses: DataFrame, models: Sequence[str],
          check_syntax: bool = False, bleu: bool = True) -> DataFrame:
    """Per-sample results (the detail record) plus the two flags summaries need.

    ``bleu=False`` leaves ``bleu4`` out, and counts no grams beyond tokens.

    ``check_syntax`` adds ``syntax_valid`` (``bash -n`` once per distinct
    cleaned command).
    """
    paired = pair_with_responses(suite, responses, models)
    cleaned = paired.withColumn("clean_prediction", clean_command("raw_prediction"))
    kept = [c for c in RESULT_COLUMNS if bleu or c != "bleu4"]
    scored = score_pairs(cleaned, "clean_prediction", "gold", batches=True, bleu=bleu).select(*kept)
    flagged = with_format_flags(scored)
    if not check_syntax:
        return flagged
    # The flags come before the join: a summary then takes no answer's text across the network.
    return with_syntax(flagged, responses, models).select(*kept, "syntax_valid", "single_line", "output_chars")


def answer_commands(responses: DataFrame, models: Sequence[str]) -> DataFrame:
    """Every command the results can hold: the cleaned answers of the requested
    models plus the empty command a missing answer becomes."""
    spark = responses.sparkSession
    cleaned = (responses.where(F.col("model").isin(list(models)))
               .select(clean_command(F.coalesce(strip("raw_prediction"), F.lit(""))).alias("clean_prediction")))
    return cleaned.unionByName(spark.createDataFrame([("",)], "clean_prediction string"))


def with_syntax(results: DataFrame, responses: DataFrame, models: Sequence[str]) -> DataFrame:
    """``syntax_valid`` for scored results, with the parser verdicts computed
    from the answers table, so the scored pipeline runs once."""
    from .syntax import attach, verdicts
    return attach(results, verdicts(answer_commands(responses, models)))


def with_format_flags(results: DataFrame) -> DataFrame:
    """``single_line`` and ``output_chars``, both functions of the stripped raw answer."""
    return (results.withColumn("single_line", single_line("raw_prediction"))
            .withColumn("output_chars", output_chars("raw_prediction")))


def sample_results(results: DataFrame) -> DataFrame:
    """The stored detail record (the two extra flags are not kept)."""
    return results.select(*[c for c in RESULT_COLUMNS + ["syntax_valid"] if c in results.columns])


def summarise(results: DataFrame, by: Sequence[str] = ("model", "suite")) -> DataFrame:
    """One row per (model, suite): the published means, rounded as Python rounds them.

    Sums are exact (``exact_sum``): no partitioning changes a digit.

    Partial aggregation runs map-side, so even a suite holding most rows
    shuffles only one small record per task.
    """
    n = F.count(F.lit(1))

    def pct(c):
        return round_exact(exact_sum(F.col(c).cast("double"), SCORE_BITS) / n * F.lit(100.0), 2)

    def seconds(c):
        return exact_sum(c.cast("double"), SECONDS_BITS)

    aggs = [n.alias("num_samples"),
            pct("em").alias("exact_match_pct"),
            pct("f1").alias("mean_token_f1"),
            pct("bleu4").alias("mean_bleu4")]
    if "syntax_valid" in results.columns:
        aggs.append(pct("syntax_valid").alias("syntax_validity_pct"))
    aggs += [pct("single_line").alias("single_line_clean_pct"),
             round_exact(seconds(F.col("latency")) / n, 2).alias("avg_latency_sec"),
             round_exact(F.sum("output_chars").cast("double") / n, 1).alias("avg_output_chars"),
             F.sum(F.col("is_error").cast("bigint")).alias("n_errors"),
             round_exact(F.try_divide(seconds(F.when(~F.col("is_error"), F.col("latency"))),
                                      F.count(F.when(~F.col("is_error"), F.col("latency"))).cast("double")), 2)
             .alias("avg_latency_ok")]
    return results.groupBy(*by).agg(*aggs)
