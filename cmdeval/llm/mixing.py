"""Operator 6: mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled but fixed order, gone
through up to ``max_repeat`` times. The virtual finish time of a copy is the
words of its source up to its end, divided by the source's weight. All copies
are sorted globally by that time (range partitions, never one task). Going
through them in that order, the words served when a copy finishes are those of
the sources that have run out before, and for the others their weight times the
time: running totals over the order. The first copy at which they pass the total
budget is the cut. Copies before it are taken whole; of the copy that a source
still has in service at the cut, the words up to the time at which the budget
is spent; of later ones nothing. So each source ends within a word of its
target, which is reported and decides nothing.

Sources by code point, null last, take ``weights`` in turn. The budget is
``share`` of all words. Target of a source: ``min(max_repeat * size, weight * V)``
with the one V at which the targets add up to the budget.

Null text has size 0; a document without words takes nothing. Rows that repeat
others are documents of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, materialise, prefix_sums

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_repeat: int = MAX_REPEAT) -> tuple[DataFrame, float]:
    """(source, source_size, source_start, weight, target), a row for each source, and the budget.

    ``sizes`` has (source, source_size), a row for each source; ``source_start``
    is the words of the sources before it.
    """
    ranked = prefix_sums(sizes.withColumn("_one", F.lit(1).cast("bigint")), [F.col("source").asc_nulls_last()],
                         {"_one": "_rank", "source_size": "source_start"}, "mix-sources")
    turn = (F.pmod("_rank", F.lit(len(weights))) + 1).cast("int")
    capped = (ranked.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), turn).cast("bigint"))
              .withColumn("_cap", (F.lit(max_repeat) * F.col("source_size")).cast("bigint"))
              .withColumn("_ratio", F.col("_cap") / F.col("weight")))
    filled = prefix_sums(capped, [F.col("_ratio"), F.col("_rank")], {"_cap": "_caps", "weight": "_weights"}, "mix-levels")
    words, weight = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = float(share) * (words or 0)
    # With the sources before this one at their caps, the others share the rest. The level is the largest of these.
    level = filled.agg(F.max((F.lit(budget) - F.col("_caps")) / (F.lit(weight) - F.col("_weights")))).first()[0]
    target = F.least(F.col("_cap").cast("double"), F.col("weight") * F.lit(level).cast("double"))
    return filled.select("source", "source_size", "source_start", "weight", target.alias("target")), budget


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT,
        seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, source, text_key, size, source_size, target, taken), a row for each document.

    ``text_key`` is a hash of the text, for joins back to documents whose ids repeat.
    """
    queue = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(text).alias("text_key"),
        F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).alias("_key"))
    order = ["_key", "doc_id", "size", "text_key"]
    queue = prefix_sums(queue, [F.col("source").asc_nulls_last(), *map(F.col, order)], {"size": "_at"}, "mix-queue")
    queue = materialise(queue, "mix-queued")
    targets, budget = source_targets(queue.groupBy("source").agg(F.sum("size").alias("source_size")),
                                     weights, share, max_repeat)
    targets = materialise(targets, "mix-targets")
    copies = (queue.where("size > 0").withColumnRenamed("source", "_s")
              .join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
              .withColumn("_pass", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("_start", F.col("_at") - F.col("source_start") + F.col("_pass") * F.col("source_size"))
              .withColumn("_finish", (F.col("_start") + F.col("size")) / F.col("weight")))
    full = F.col("source_size") * max_repeat
    # A source runs out with its last copy: from then on it takes no share of the service.
    out_ = F.col("_start") + F.col("size") == full
    copies = (copies.withColumn("_out", F.when(out_, full).otherwise(F.lit(0)).cast("bigint"))
              .withColumn("_left", F.when(out_, F.col("weight")).otherwise(F.lit(0)).cast("bigint")))
    served = prefix_sums(copies, [F.col("_finish"), F.col("source").asc_nulls_last(), F.col("_pass"), *map(F.col, order)],
                         {"_out": "_gone", "_left": "_idle"}, "mix-served")
    weight = targets.agg(F.sum("weight")).first()[0] or 0
    spent = F.col("_gone") + F.col("_finish") * (F.lit(weight) - F.col("_idle"))
    cut = (served.where(spent > F.lit(budget)).agg(F.min(F.struct("_finish", "_gone", "_idle")).alias("x")).first()["x"])
    taken = F.col("size")
    if cut is not None:
        time = (budget - cut["_gone"]) / (weight - cut["_idle"])
        due = F.floor(F.col("weight") * F.lit(time) - F.col("_start") + 0.5)
        taken = F.when(spent <= F.lit(budget), taken).otherwise(F.least(taken, F.greatest(F.lit(0).cast("bigint"), due)))
    # A document's place in its queue names it: places of documents with words differ.
    got = (served.withColumn("_taken", taken).where("_taken > 0")
           .groupBy(F.col("_at").alias("_a"), F.col("_key").alias("_k")).agg(F.sum("_taken").alias("taken")))
    out = (queue.join(got, (F.col("_at") == F.col("_a")) & (F.col("_key") == F.col("_k")) & (F.col("size") > 0), "left")
           .withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source"))))
    return out.select("doc_id", "source", "text_key", "size", "source_size", "target",
                      F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
