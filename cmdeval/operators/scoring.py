"""Pair scoring: token bags, n-gram overlaps, token F1 and BLEU-4.

Every metric of a pair depends only on that pair's row, so scoring is a
chain of projections: no exchange. The bag view (``token_counts``) too counts
inside the row. Bags of many rows are matched and counted an Arrow batch at a
time (``bags``); ``score_pairs`` can do without Python, at several times the cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import BLEU_MAX_ORDER
from ..functions.metrics import (bleu4_from_counts, exact_match, f1_from_counts, multiset_overlap, next_codes,
                                 token_codes)
from ..functions.text import tokens
from ..session import ensure_package_on_workers
from . import bags

ORDERS = tuple(range(1, BLEU_MAX_ORDER + 1))


def with_overlaps(df: DataFrame, pred: str = "clean_prediction", gold: str = "gold", batches: bool = False,
                  orders: tuple[int, ...] = ORDERS) -> DataFrame:
    """Adds the bags' sizes ``_np``/``_ng`` and the ``_m1.._m4`` overlaps.

    Tokens are coded once and shared by F1 and every BLEU order. ``batches`` matches the bags in Arrow batches, by
    exact codes, without the columns of codes, for the first of the ``orders`` only if need be.
    """
    if batches:
        ensure_package_on_workers(df.sparkSession)
        # Lower-cased once, for the exact match as well.
        out = df.withColumns({"_lp": F.lower(pred), "_lg": F.lower(gold)})
        out = out.withColumn("_m", bags.overlaps("_lp", "_lg", len(orders)))
        of_null = F.size(F.lit(None).cast("array<string>"))
        sizes = {f"_n{side}": F.when(F.col(text).isNull(), of_null).otherwise(F.col("_m")[i])
                 for i, (side, text) in enumerate((("p", pred), ("g", gold)))}
        return out.withColumns(sizes | {f"_m{n}": F.col("_m")[n + 1] for n in orders}).drop("_m")
    out = (df.withColumn("_pt", token_codes(tokens(pred))).withColumn("_gt", token_codes(tokens(gold)))
           .withColumn("_np", F.size("_pt")).withColumn("_ng", F.size("_gt")))
    out = with_code_orders(with_code_orders(out, "_pt", "_p"), "_gt", "_g")
    for n in ORDERS:
        # An order missing on either side has no grams to match.
        both = (F.col("_np") >= n) & (F.col("_ng") >= n)
        out = out.withColumn(f"_m{n}", F.when(both, multiset_overlap(f"_p{n}", f"_g{n}")).otherwise(F.lit(0)))
    return out.drop(*[f"{side}{n}" for side in ("_p", "_g") for n in ORDERS if n > 1])


def with_code_orders(df: DataFrame, tok: str, prefix: str) -> DataFrame:
    """Columns ``prefix1..prefix4``: the codes of each order built from the previous one."""
    out = df.withColumn(f"{prefix}1", F.col(tok))
    for n in ORDERS[1:]:
        out = out.withColumn(f"{prefix}{n}", next_codes(f"{prefix}{n - 1}", tok, n))
    return out


def score_pairs(df: DataFrame, pred: str = "clean_prediction", gold: str = "gold",
                keep_counts: bool = False, batches: bool = False, bleu: bool = True) -> DataFrame:
    """Adds ``em``, ``f1`` and ``bleu4`` columns (``bleu=False``: not the last); see ``with_overlaps`` for ``batches``."""
    out = with_overlaps(df, pred, gold, batches, ORDERS if bleu else ORDERS[:1])
    n_pred, n_gold = F.col("_np"), F.col("_ng")
    texts = ("_lp", "_lg") if batches else (pred, gold)
    out = out.withColumn("em", exact_match(*texts, lowered=batches)).withColumn("f1", f1_from_counts(F.col("_m1"), n_pred, n_gold))
    if bleu:
        out = out.withColumn("bleu4", bleu4_from_counts([F.col(f"_m{n}") for n in ORDERS], n_pred, n_gold))
    helpers = ["_lp", "_lg", "_pt", "_gt", "_np", "_ng", "_p1", "_g1"] + [f"_m{n}" for n in ORDERS]
    return out.drop("_lp", "_lg") if keep_counts else out.drop(*helpers)


def ngram_overlap(df: DataFrame, keys: list[str], pred: str = "clean_prediction",
                  gold: str = "gold") -> DataFrame:
    """One row per (pair, n): matched n-grams and the n-gram totals of both sides."""
    out = with_overlaps(df, pred, gold, batches=True)
    rows = F.array(*[
        F.struct(F.lit(n).cast("bigint").alias("n"),
                 F.greatest(F.col("_np") - F.lit(n - 1), F.lit(0)).cast("bigint").alias("pred_ngrams"),
                 F.greatest(F.col("_ng") - F.lit(n - 1), F.lit(0)).cast("bigint").alias("gold_ngrams"),
                 F.col(f"_m{n}").cast("bigint").alias("matched"))
        for n in ORDERS])
    return out.select(*keys, F.inline(rows))


def token_counts(df: DataFrame, keys: list[str], pred: str = "clean_prediction",
                 gold: str = "gold") -> DataFrame:
    """Multiset view of both bags: (keys, side, n, gram, cnt).

    Counted inside the row, an Arrow batch of rows at a time (``bags.counter``). No exchange is added, whatever the
    plan below, and a very long answer costs O(n) in its own row. The keys are those of one row, as in all scoring.
    """
    ensure_package_on_workers(df.sparkSession)
    staged = df.select(*keys, bags.prepared(pred).alias("_pt"), bags.prepared(gold).alias("_gt"))
    schema = T.StructType([*staged.select(*keys).schema.fields, T.StructField("side", T.StringType()),
                           T.StructField("n", T.LongType()), T.StructField("gram", T.StringType()),
                           T.StructField("cnt", T.LongType())])
    return staged.mapInArrow(bags.counter(keys, {"_pt": "pred", "_gt": "gold"}), schema)
