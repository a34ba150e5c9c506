"""A training corpus from ``documents``: toxic texts out, repeated lines out, one of each group of near
copies, sources mixed to target weights, texts encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All stages but the last return the columns of
``documents``. Null ids, null and empty texts, repeated rows and empty tables end as the operators'
docstrings say; columns that ``docs`` has besides pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cmdeval.llm import line_dedup, mixing, ngram_join, sentencepiece_scan, toxicity
from cmdeval.llm.common import apart, materialise, table

#: Near copies among documents: shingles of five words, Jaccard similarity in per cent.
SHINGLE_WORDS, SHINGLE_SIMILARITY = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the labelled neighbours don't call toxic."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return toxicity.score(docs, labels).where("predicted = 0").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat or resemble earlier ones; a text may end up empty."""
    return line_dedup.dedup_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; documents without words stay."""
    found = ngram_join.join_components(docs, SHINGLE_WORDS, SHINGLE_SIMILARITY)
    order = F.struct("doc_id", "text_key")
    kept = (found.where("n_shingles > 0").groupBy("group").agg(F.min(order).alias("x")).select("x.*")
            .union(found.where("n_shingles = 0").select("doc_id", "text_key")).distinct()
            .select(F.col("doc_id").alias("_i"), F.col("text_key").alias("_k")))
    columns, (docs, back) = docs.columns, apart(docs, "_t", "_i", "_k")
    keyed = docs.withColumn("_t", F.xxhash64("text"))
    return (keyed.join(kept, keyed["doc_id"].eqNullSafe(kept["_i"]) & (keyed["_t"] == kept["_k"]), "left_semi")
            .dropDuplicates(["doc_id", "_t"]).drop("_t").withColumnsRenamed(back).select(*columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, rounded to whole copies; of a source that would have none
    by that, one copy of the document of which the mix takes most."""
    same = ["doc_id", "source", "text_key"]
    plan = materialise(mixing.mix(docs).where("taken > 0"), "mix-plan")
    plan = (plan.withColumn("_n", F.row_number().over(Window.partitionBy(*same).orderBy(F.desc("taken"))))
            .select(*[F.col(c).alias(f"_{c}") for c in same], "_n", "taken",
                    F.floor(F.col("taken") / F.col("size") + 0.5).cast("int").alias("_copies")))
    most = F.max(F.struct("taken", "_doc_id", "_text_key", "_n")).alias("x")
    bare = plan.groupBy("_source").agg(F.sum("_copies").alias("_all"), most).where("_all = 0")
    plan = plan.where("_copies > 0").drop("taken").unionByName(
        bare.select("x._doc_id", "_source", "x._text_key", "x._n", F.lit(1).alias("_copies")))
    columns, (docs, back) = docs.columns, apart(docs, "_t", "_m", "_copy", *plan.columns)
    keyed = docs.withColumn("_t", F.xxhash64("text"))
    keyed = keyed.withColumn("_m", F.row_number().over(Window.partitionBy("doc_id", "source", "_t").orderBy(F.lit(1))))
    on = (keyed["doc_id"].eqNullSafe(plan["_doc_id"]) & keyed["source"].eqNullSafe(plan["_source"])
          & (keyed["_t"] == plan["_text_key"]) & (keyed["_m"] == plan["_n"]))
    return (keyed.join(plan, on).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
            .select(*docs.columns).withColumnsRenamed(back).select(*columns))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens, round_trip) of every row."""
    return sentencepiece_scan.encode(docs).select("doc_id", "lang", "source", "ids", "n_tokens", "round_trip")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode_texts),
]

#: SQL has no TF-IDF index, Unicode tokenizer or fair queue over the results of both; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
