"""Model comparison, Markdown table and the JSON report sink."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import REPORT_HEADER, REPORT_METRICS, REPORT_RULE
from ..functions.metrics import plain_number, round_exact
from ..session import shuffle_files_go
from .evaluate import sample_results, summarise, with_format_flags


#: Records of the JSON report, as ``write_json`` writes them.
DETAIL_SCHEMA = ("id bigint, nl string, gold string, raw_prediction string, clean_prediction string, em double, f1 double, "
                 "bleu4 double, latency double, is_error boolean, model string, suite string")
SUMMARY_SCHEMA = ("model string, suite string, num_samples bigint, exact_match_pct double, mean_token_f1 double, "
                  "mean_bleu4 double, single_line_clean_pct double, avg_latency_sec double, avg_output_chars double, "
                  "n_errors bigint, avg_latency_ok double")


def compare(summary: DataFrame, base: str, tuned: str,
            metrics: Sequence[tuple[str, str, str, str]] = REPORT_METRICS,
            tracks: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """(suite, metric, metric_ord, base, tuned, delta) for every metric present.

    ``tracks`` names the metrics of a suite; a suite that it doesn't name has all.

    ``delta`` is tuned - base; for latency it is the percent by which tuned is
    faster, rounded to 0.1, NULL when the base latency is 0.
    """
    present = [(i, m) for i, m in enumerate(metrics, 1) if m[0] in summary.columns]
    if not present:
        raise ValueError("summary has none of the report metrics")
    stacked = F.explode(F.array(*[
        F.struct(F.lit(m[0]).alias("metric"), F.lit(i).cast("bigint").alias("metric_ord"),
                 F.lit(m[3]).alias("kind"), F.col(m[0]).cast("double").alias("value"))
        for i, m in present]))
    long = (summary.where(F.col("model").isin(base, tuned))
            .select("model", "suite", stacked.alias("r"))
            .select("model", "suite", "r.*"))
    for suite, names in (tracks or {}).items():
        long = long.where((F.col("suite") != suite) | F.col("metric").isin(list(names)))
    of = {m: F.max(F.when(F.col("model") == m, F.col("value"))) for m in (base, tuned)}
    wide = (long.groupBy("suite", "metric", "metric_ord", "kind")
            .agg(of[base].alias("base"), of[tuned].alias("tuned")))
    faster = F.when(F.col("base") == 0, F.lit(None).cast("double")).otherwise(
        round_exact((F.lit(1.0) - F.col("tuned") / F.col("base")) * F.lit(100.0), 1))
    delta = F.when(F.col("kind") == "faster", faster).otherwise(F.col("tuned") - F.col("base"))
    return wide.select("suite", "metric", "metric_ord", "base", "tuned", delta.alias("delta"))


def _num(c: Column) -> Column:
    return F.coalesce(plain_number(c), F.lit("n/a"))


def markdown(cmp: DataFrame, base_label: str = "base", tuned_label: str = "tuned",
             metrics: Sequence[tuple[str, str, str, str]] = REPORT_METRICS) -> DataFrame:
    """Markdown lines (suite, line_no, line): a title, the header, one row per metric."""
    spec = F.create_map(*[x for m in metrics for x in (F.lit(m[0]), F.struct(
        F.lit(m[1]).alias("name"), F.lit(m[2]).alias("unit"), F.lit(m[3]).alias("kind")))])
    meta = F.element_at(spec, F.col("metric"))
    unit = meta["unit"]
    improvement = F.when(
        meta["kind"] == "faster",
        F.concat(F.lit("⚡ "), _num(F.col("delta")), F.lit("% faster")),
    ).otherwise(F.concat(F.lit("+"), _num(round_exact(F.col("delta"), 1)), unit))
    row_line = F.concat_ws(" | ",
                           F.concat(F.lit("| "), meta["name"]),
                           F.concat(_num(F.col("base")), unit),
                           F.concat(F.lit("**"), _num(F.col("tuned")), unit, F.lit("**")),
                           F.concat(improvement, F.lit(" |")))
    rows = cmp.select("suite", (F.col("metric_ord") + 2).alias("line_no"), row_line.alias("line"))
    head = F.array(
        F.struct(F.lit(0).cast("bigint").alias("line_no"), F.concat(F.lit("### "), F.col("suite")).alias("line")),
        F.struct(F.lit(1).cast("bigint").alias("line_no"),
                 F.lit(REPORT_HEADER.format(base=base_label, tuned=tuned_label)).alias("line")),
        F.struct(F.lit(2).cast("bigint").alias("line_no"), F.lit(REPORT_RULE).alias("line")))
    headers = cmp.select("suite").distinct().select("suite", F.inline(head))
    return headers.unionByName(rows)


def write_markdown(lines: DataFrame, path: str) -> None:
    """One text file; the input is bounded by suites x metrics."""
    (lines.repartition(1).sortWithinPartitions("suite", "line_no")
     .select("line").write.mode("overwrite").text(path))


MODELS_SCHEMA = "model string, label string"

#: Of gzipped details, by Hadoop's name: a sixth more bytes than by its default, in less than half the CPU seconds.
GZIP_LEVEL = "THREE"


def _finished(spark: SparkSession, folder: str) -> dict[int, str]:
    """Finished folders ``version=N`` by their number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if n.startswith("version=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}/_SUCCESS"))]
    return {int(n.removeprefix("version=")): f"{folder}/{n}" for n in done}


def write_json(results: DataFrame, path: str, labels: Mapping[str, str] | None = None, compression: str | None = None,
               slices: int = 1) -> dict[str, str]:
    """Publish a JSON report: details, summary and the models' labels, all of one version.

    A version's files are written to a folder of its own and its manifest last; readers take the newest manifest, so
    they see a whole report or the one before, also while a run writes or after it was killed.

    Details are partitioned by model and suite and sorted by id inside every file; they are never gathered into one
    nested record, since a suite can be far larger than one task. The summary is computed from the written details
    (the format flags are recomputed from ``raw_prediction``), so scoring runs once and the lineage is cut at the
    files. A model without a label is labelled by its name.

    A record holds its text four times over: ``compression`` (a codec of Spark's JSON writer, ``gzip``) is for details
    too large to lie about as plain text. ``slices`` deals the samples by their ids into so many writes, one after the
    other, each of which leaves no shuffle files; ``results`` are computed anew for each, so ids must not change from
    one run to the next.
    """
    spark = results.sparkSession
    version = max(_finished(spark, f"{path}/manifests"), default=0) + 1
    folder = f"{path}/files/{uuid.uuid4().hex}"
    out = {"summary": f"{folder}/summary", "results": f"{folder}/results", "models": f"{folder}/models"}
    details = sample_results(results)
    dealt = F.pmod(F.xxhash64("id"), F.lit(slices))
    with shuffle_files_go(spark):
        for k in range(slices):
            part = details.where(dealt == k) if slices > 1 else details
            (part.sortWithinPartitions("model", "suite", "id").write.mode("append").option("zlib.compress.level", GZIP_LEVEL)
             .partitionBy("model", "suite").json(out["results"], compression=compression))
    written = spark.read.schema(details.schema).json(out["results"])
    summary = summarise(with_format_flags(written))
    summary.write.json(out["summary"])
    models = spark.read.schema(summary.schema).json(out["summary"]).select("model").distinct()
    label = F.col("model")
    for model, text in (labels or {}).items():
        label = F.when(F.col("model") == model, F.lit(text)).otherwise(label)
    models.select("model", label.alias("label")).coalesce(1).write.json(out["models"])
    manifest = spark.createDataFrame([(version, folder)], "version bigint, folder string")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifests/version={version}")
    return out


def _published(spark: SparkSession, path: str) -> str:
    """Folder of the newest whole report."""
    versions = _finished(spark, f"{path}/manifests")
    if not versions:
        raise FileNotFoundError(f"no report in {path}")
    return spark.read.schema("folder string").json(versions[max(versions)]).first()["folder"]


def read_json_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(summary, details) of the newest whole report."""
    folder = _published(spark, path)
    return (spark.read.schema(SUMMARY_SCHEMA).json(f"{folder}/summary"),
            spark.read.schema(DETAIL_SCHEMA).json(f"{folder}/results"))


def read_models(spark: SparkSession, path: str) -> DataFrame:
    """(model, label) of the newest whole report."""
    return spark.read.schema(MODELS_SCHEMA).json(f"{_published(spark, path)}/models")
