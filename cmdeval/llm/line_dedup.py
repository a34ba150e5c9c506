"""Operator 5: line dedup by an exact set-similarity join, in DataFrame operations only.

A line's tokens are its distinct lower-case words (runs without white space).
Going through the lines in order of (doc_id, hash of the document, line number),
a line is removed if an earlier line has a Jaccard similarity of at least
``similarity`` per cent with it, whether that line stays or not. Lines without
words always stay. All other lines stay as they are, in order.

* Lines that are equal but for case and the kind of white space form a class,
  grouped before any word is looked at, so a line that fills the corpus is one
  row from then on. All lines of a class but the first go. The first goes if the
  first line of another, similar class comes earlier.
* Tokens are ordered by rarity: counts over all classes, kept for ``BUCKETS``
  hash buckets (a fixed size that one array holds), on a logarithmic scale, ties
  by the token's hash. The array is a scalar subquery: not a part of the plan.
* Prefix filter: similar classes share one of their ``size - ceil(t * size) + 1``
  rarest tokens. Length filter: sizes within the similarity. Positional filter:
  from the first common token on, enough tokens must be left on both sides.
* Each posting carries 128 bits, the parities of the class's tokens in 128 cells.
  Two sets differ in at least as many tokens as these in bits, which settles most
  pairs inside the join, before they become rows.
* Candidates are verified on the full token sets.

Every step ends in files; the shuffle files behind it go as soon as these are written.

Documents with equal id and text are one document and end alike. Null text
stays null. A null id sorts first. All columns pass; text is replaced, n_chars
where it exists, and n_lines and n_removed are added. An empty table gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, materialise

SIMILARITY = 80  # per cent
BUCKETS = 1 << 19
BLOCK = 1 << 10  # buckets gathered at once
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _step(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``materialise``, without leaving the shuffle files to the driver's garbage collector."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return materialise(df, name, compression)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def line_tokens(line: Column | str) -> Column:
    """Hashes of the distinct words of a line of ``_lines``."""
    words = F.array_remove(F.split(line, " "), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _lines(docs: DataFrame) -> DataFrame:
    """(at, line, k, k2): every line with words, in lower case and with spaces as its only white space;
    ``at`` orders the lines, ``k`` and ``k2`` name the class."""
    plain = F.regexp_replace(F.lower("_text"), r"[\x09\x0B-\x0D]", " ")
    each = docs.select("_id", "_key", F.posexplode(F.split(plain, "\n")).alias("_pos", "line"))
    return each.where(F.btrim("line") != "").select(
        F.struct("_id", "_key", "_pos").alias("at"), "line", F.xxhash64("line").alias("k"),
        F.xxhash64(F.lit(1), "line").alias("k2"))


def _levels(classes: DataFrame) -> DataFrame:
    """One row: how frequent the words of each hash bucket are, on a logarithmic scale."""
    seen = classes.select(F.explode(F.split("line", " ")).alias("w")).where("w <> ''")
    counts = seen.groupBy(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.lit(127), F.floor(4 * F.log2(F.coalesce("n", F.lit(0)) + 1))).cast("tinyint")
    every = classes.sparkSession.range(BUCKETS).withColumnRenamed("id", "b").join(counts, "b", "left")

    def in_order(key: str, value: Column) -> Column:
        return F.sort_array(F.collect_list(F.struct(key, value.alias("v")))).getField("v").alias("v")
    # BUCKETS pairs of numbers, whatever the corpus, and then a row for each block of them.
    blocks = every.groupBy(F.floor(F.col("b") / BLOCK).alias("block")).agg(in_order("b", level))
    return _step(blocks.agg(in_order("block", F.col("v"))).select(F.flatten("v").alias("levels")), "line-rarity")


def _by_rarity(tokens: Column, levels: Column) -> Column:
    """Tokens as numbers that sort by rarity: the level of the bucket above 56 bits of the hash."""
    def packed(t: Column) -> Column:
        level = F.get(levels, t.bitwiseAND(BUCKETS - 1).cast("int")).cast("bigint")
        return F.shiftleft(level, 56).bitwiseOR(F.shiftrightunsigned(t, 8))
    return F.sort_array(F.transform(tokens, packed))


def _candidates(classes: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) of classes that pass the prefix, length, positional and parity filters."""
    # Never null, or the join would ask that of the whole expression and rank every line twice.
    size = F.coalesce(F.size("ranked"), F.lit(0))
    prefix = size - F.ceil(size * similarity / 100).cast("int") + 1
    tokens = (classes.select("k", size.alias("n"), "parity", "parity2", F.posexplode(F.slice("ranked", F.lit(1), prefix)).alias("i", "t"))
              .withColumn("t", F.col("t").bitwiseAND(0x7FFFFFFF).cast("int")))  # tokens that meet by chance are settled below
    # All filters need both sides: one of a side alone would make it another exchange, and every line would be ranked twice.
    a, b = tokens.alias("a"), tokens.alias("b")
    an, bn, ai, bi = (F.col(c) for c in ("a.n", "b.n", "a.i", "b.i"))
    near = (an * 100 >= bn * similarity) & (bn * 100 >= an * similarity)
    room = F.least(an - ai, bn - bi) * (100 + similarity) >= similarity * (an + bn)
    one, two = (F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}")) for c in ("parity", "parity2"))
    differ = F.bit_count(two) + F.bit_count(one.bitwiseXOR(two))
    few = differ * (100 + similarity) <= (100 - similarity) * (an + bn)
    return (a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.k") < F.col("b.k")) & near & room & few)
            .select(F.col("a.k").alias("a"), F.col("b.k").alias("b")).distinct())


#: Columns that stand beside those of the documents on the way.
HELPERS = ("_id", "_key", "_text", "_lines", "_rid", "_rkey", "_removed")


def dedup_lines(docs: DataFrame, similarity: int = SIMILARITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that repeat earlier ones; n_lines and n_removed are added."""
    columns, (docs, back) = docs.columns, apart(docs, *HELPERS)
    keyed = (docs.withColumn("_id", F.col(doc_id)).withColumn("_key", F.xxhash64(doc_id, text))
             .withColumn("_lines", F.split(text, "\n")))
    lines = _lines(docs.select(F.col(doc_id).alias("_id"), F.xxhash64(doc_id, text).alias("_key"), F.col(text).alias("_text")))
    classes = _step(lines.groupBy("k", "k2").agg(F.min(F.struct("at", "line")).alias("x"), F.count(F.lit(1)).alias("copies"))
                          .select("k", "k2", F.col("x.at").alias("first"), "copies", "x.line"), "line-classes", "zstd")
    # Equal lines: all but the first line of each class go.
    firsts = classes.where("copies > 1").select("k", "k2", "first")
    repeats = lines.select("at", "k", "k2").join(firsts, ["k", "k2"]).where(F.col("at") > F.col("first")).select("at")
    levels = _levels(classes).scalar()
    # The subquery's column is used once, so the plan takes it into the expression and no row carries the array.
    ranked = classes.select("k", line_tokens("line").alias("tokens"), levels.alias("levels"))
    ranked = ranked.select("k", _by_rarity(F.col("tokens"), F.col("levels")).alias("ranked"))
    parity = F.expr("coalesce(aggregate(ranked, 0L, (x, t) -> x ^ shiftleft(1L, cast(t & 63 AS int))), 0L)")
    # The same of the tokens with the next bit set: the other cells' parities are the difference of both.
    parity2 = F.expr("coalesce(aggregate(ranked, 0L, (x, t) -> x ^ shiftleft(shiftright(t, 6) & 1L, cast(t & 63 AS int))), 0L)")
    ranked = ranked.withColumns({"parity": parity, "parity2": parity2})
    pairs = _step(_candidates(ranked, similarity), "line-candidates")
    live = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    sets = _step(classes.join(live, "k", "left_semi").select("k", "first", line_tokens("line").alias("tokens")), "line-sets")
    both = (pairs.join(sets.select(F.col("k").alias("a"), F.col("first").alias("fa"), F.col("tokens").alias("ta")), "a")
            .join(sets.select(F.col("k").alias("b"), F.col("first").alias("fb"), F.col("tokens").alias("tb")), "b"))
    common = F.size(F.array_intersect("ta", "tb"))
    similar = common * (100 + similarity) >= similarity * (F.size("ta") + F.size("tb"))
    later = both.where(similar).select(F.greatest("fa", "fb").alias("at")).distinct()
    removed = _step(repeats.union(later).groupBy("at._id", "at._key")
                    .agg(F.collect_set("at._pos").alias("_removed")).withColumnsRenamed({"_id": "_rid", "_key": "_rkey"}), "line-removed")
    n = F.size("_lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("_removed"))
    # The lines are a column of the join's output here, so they are split once a document.
    cut = F.when(F.col("_removed").isNotNull(), F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")).otherwise(
        F.array_join("_lines", "\n"))
    out = (keyed.drop(text).join(removed, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_key") == F.col("_rkey")), "left")
           .withColumn(text, cut)
           .withColumn("n_lines", F.coalesce(F.when(F.col("_lines").isNotNull(), n), F.lit(0)).cast("bigint"))
           .withColumn("n_removed", F.coalesce(F.when(F.col("_removed").isNotNull(), F.size("_removed")), F.lit(0)).cast("bigint")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    added = [c for c in ("n_lines", "n_removed") if c not in columns]
    return out.drop(*HELPERS).withColumnsRenamed(back).select(*columns, *added)
