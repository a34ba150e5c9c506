"""Readers and the corpus sink.

Text formats (JSON lines, CSV) are read with the declared schema, never
inferred; Parquet is read as is and projected onto the schema so column
pruning and filter pushdown reach the scan. Training pairs come under any of
their names: JSON lines are parsed to Variant values, so the names need neither
a schema nor a pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import COMMAND_ALIASES, INSTRUCTION_ALIASES
from ..operators.ordering import numbered, numbered_as_read
from .schemas import (GPU_SAMPLE_SCHEMA, PAIR_SCHEMA, RESPONSE_SCHEMA, RUN_LOG_SCHEMA,
                      SUITE_SCHEMA)


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    p = path.rstrip("/").lower()
    for ext, name in ((".json", "json"), (".jsonl", "json"), (".csv", "csv"), (".parquet", "parquet")):
        if p.endswith(ext):
            return name
    return "parquet"


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None,
               project: bool = True, multi_line: bool = False) -> DataFrame:
    """``multi_line``: CSV values may hold line breaks; each file is then read by one task."""
    fmt = _format_of(path, fmt)
    reader = spark.read
    if fmt == "parquet":
        df = reader.parquet(path)
    elif fmt == "csv":
        df = reader.schema(schema).option("header", True).option("multiLine", multi_line).csv(path)
    else:
        df = reader.schema(schema).json(path)
    if not project:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _first_alias(record: str, aliases: tuple[str, ...]) -> tuple[Column, Column]:
    """Text under the first of these names that a Variant record has, and whether it has one. A name whose value is
    null counts as had."""
    has = [F.try_variant_get(record, f"$.{a}", "variant").isNotNull() for a in aliases]
    text = F.lit(None).cast("string")
    for h, a in reversed(list(zip(has, aliases))):
        text = F.when(h, F.try_variant_get(record, f"$.{a}", "string")).otherwise(text)
    found = F.lit(False)
    for h in has:
        found = found | h
    return text, found


def _pairs_from_json(spark: SparkSession, path: str, multi_line: bool, malformed: str,
                     instruction: tuple[str, ...], command: tuple[str, ...]) -> DataFrame:
    lines = spark.read.text(path, wholetext=multi_line).where(F.trim("value") != "")
    parse = F.parse_json if malformed == "raise" else F.try_parse_json
    if multi_line:
        each = spark.tvf.variant_explode(parse(F.col("value").outer()))
        records = lines.lateralJoin(each.select(F.col("value").alias("record"))).select("record")
    else:
        records = lines.select(parse("value").alias("record"))
    (inst, has_i), (cmd, has_c) = _first_alias("record", instruction), _first_alias("record", command)
    # A record without a name is no pair; only where no record has one is the table not one of pairs.
    named = records.select(F.try_variant_get("record", "$.pair_id", "bigint").alias("pair_id"), inst.alias("instruction"),
                           cmd.alias("command"), has_i.alias("_i"), has_c.alias("_c"))
    for column, names, what in (("_i", instruction, "instruction"), ("_c", command, "command")):
        if named.where(column).isEmpty() and not records.isEmpty():
            raise ValueError(f"no {what} column in {path}: expected one of {', '.join(names)}")
    return named.drop("_i", "_c")


def read_pairs(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool | None = None,
               malformed: str = "raise", instruction: tuple[str, ...] = INSTRUCTION_ALIASES,
               command: tuple[str, ...] = COMMAND_ALIASES) -> DataFrame:
    """Raw training pairs; ``prep.resolve_pairs`` makes (pair_id, instruction, command) of them.

    JSON: every record may use any of the names; the first that it has counts, and one in which neither is
    found has nulls. ``ValueError`` where no record at all has a name of a side. ``malformed``: "raise" stops
    at a line that isn't JSON, "drop" leaves it out. ``multi_line=True`` reads files that hold one JSON array.

    CSV: names come from the header, a doubled quote stands for one, and values may hold line breaks, so each
    file is read by one task; ``multi_line=False`` lets files be split, for values known to hold none.
    """
    if malformed not in ("raise", "drop"):
        raise ValueError(f"malformed must be 'raise' or 'drop', not {malformed!r}")
    fmt = _format_of(path, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        reader = spark.read.option("header", True).option("multiLine", multi_line is not False).option("escape", '"')
        return reader.option("mode", "FAILFAST" if malformed == "raise" else "DROPMALFORMED").csv(path)
    return _pairs_from_json(spark, path, bool(multi_line), malformed, instruction, command)


#: Rows of a Parquet file that are numbered together.
NUMBER_ROWS = 1 << 20


def read_suite(spark: SparkSession, path: str, fmt: str | None = None, name: str | None = None,
               positions: bool = False) -> DataFrame:
    """(suite, id, nl, gold) of a suite's files.

    ``name`` names the suite where the files don't. ``positions=True`` is for suites without ids: a sample's id is
    then its 1-based place inside its suite, in the order of the files' paths and of the rows in them.
    """
    fmt = _format_of(path, fmt)
    columns = [f for f in SUITE_SCHEMA.fields if not (positions and f.name == "id")]
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        reader = spark.read.schema(T.StructType(columns))
        if fmt == "csv":
            df = reader.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        else:
            df = reader.json(path)
    have = {f.name: F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType) for f in columns}
    if name is not None:
        have["suite"] = F.lit(name)
    picked = [c.alias(n) for n, c in have.items()]
    if not positions:
        return df.select(*picked)
    picked.append(F.col("_metadata.file_path").alias("_file"))
    if fmt == "parquet":
        row = F.col("_metadata.row_index")
        placed = df.select(*picked, F.expr(f"_metadata.row_index div {NUMBER_ROWS}").alias("_block"), row.alias("_at"))
        found = numbered(placed, ["suite"], "_file", "_block", "_at", "id")
    else:
        # Rows of one split are read by one task in their order.
        placed = df.select(*picked, F.col("_metadata.file_block_start").alias("_block"))
        found = numbered_as_read(placed, ["suite"], "_file", "_block", "id")
    return found.select(*[f.name for f in SUITE_SCHEMA.fields])


def _recovered(line: str, name: str, pattern: str) -> Column:
    """A field of the key, cut out of a line that isn't JSON."""
    found = F.regexp_extract(F.col(line), f'"{name}"\\s*:\\s*{pattern}', 1)
    return F.when(found != "", found)


def _response_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines parsed whole, whatever columns are asked for later: what is malformed doesn't hang on the projection."""
    fields = [*RESPONSE_SCHEMA.fields, T.StructField("response", T.StringType()), T.StructField("_bad", T.StringType())]
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = F.from_json("value", T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    df = lines.select("value", parsed.alias("r")).select("value", "r.*").withColumn("_bad", F.col("_bad").isNotNull())
    cut = {"model": _recovered("value", "model", '"([^"\\\\]*)"'), "suite": _recovered("value", "suite", '"([^"\\\\]*)"'),
           "id": _recovered("value", "id", "(-?\\d{1,18})\\s*[,}]").cast("bigint")}
    return df.withColumns({c: F.when(F.col("_bad"), F.coalesce(F.col(c), x)).otherwise(F.col(c)) for c, x in cut.items()})


def _response_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV by its header's names; a value that its column's type can't hold makes the line malformed."""
    options = {"header": True, "multiLine": True, "escape": '"', "columnPruning": False, "columnNameOfCorruptRecord": "_bad"}
    names = spark.read.options(**options).csv(path).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in (*names, "_bad")])
    df = spark.read.options(**options).schema(text).csv(path)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in RESPONSE_SCHEMA.fields if f.name in names}
    bad = F.col("_bad").isNotNull()
    for c, value in typed.items():
        bad = bad | (value.isNull() & F.col(c).isNotNull())
    return df.select(*[typed.get(c, F.col(c)).alias(c) for c in names], bad.alias("_bad"))


def read_responses(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Answers as a predictor logs them, failures included: (model, suite, id, raw_prediction, latency, is_error,
    ts, error).

    A call failed where it is flagged so, where its body is an error, where it has no text, and where its line
    is malformed (cut off, or a value of the wrong type). ``is_error`` is never null; ``error`` says why:
    ``malformed``, the error body, ``flagged`` or ``no text``. A malformed JSON line keeps the key as far as it
    can be read; without a key it answers nothing but is still a row, so failures can be counted. A dump may
    lack the optional columns. The answer may stand under ``response``, the service's own name.
    """
    fmt = _format_of(path, fmt)
    if fmt == "parquet":
        df = spark.read.parquet(path).withColumn("_bad", F.lit(False))
    else:
        df = _response_csv(spark, path) if fmt == "csv" else _response_lines(spark, path)
    absent = [f for f in (*RESPONSE_SCHEMA.fields, T.StructField("response", T.StringType())) if f.name not in df.columns]
    df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
    text = F.coalesce("raw_prediction", "response")
    why = (F.when(F.col("_bad"), F.lit("malformed")).when(F.col("error").isNotNull(), F.col("error"))
           .when(F.col("is_error"), F.lit("flagged")).when(text.isNull(), F.lit("no text")))
    made = {"raw_prediction": text, "error": why, "is_error": why.isNotNull()}
    return df.select(*[made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in RESPONSE_SCHEMA.fields])


def read_run_log(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, RUN_LOG_SCHEMA, fmt)


def read_gpu_samples(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, GPU_SAMPLE_SCHEMA, fmt)


def write_corpus(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Formatted-corpus sink: Parquet with the rendered ``text`` column."""
    if "text" not in df.columns:
        raise ValueError("corpus needs a 'text' column (see prep.render_training)")
    df.write.mode(mode).parquet(path)


__all__ = ["read_table", "read_pairs", "read_suite", "read_responses", "read_run_log",
           "read_gpu_samples", "write_corpus", "PAIR_SCHEMA"]
