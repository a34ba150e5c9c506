"""Named queries over the shared test tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads whole tables (or what Spark derives from them) and returns
a lazy DataFrame; nothing is collected here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn
from ..functions.text import clean_command, cut_at_stop, last_line
from ..operators import evaluate, predict, prep, report, scoring, telemetry
from ..constants import SHORT_REPORT
from ..session import scratch_path, shuffle_files_go
from ..sources import fixtures, read_pairs, read_responses, read_suite
from .. import streaming

MODELS = fixtures.SIM_MODELS
KEYS = ["model", "suite", "id"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _suite(spark, d):
    return fixtures.suite_from_documents(table(spark, d, "documents"))


def _answers(spark, d):
    """Both models' answers to every document."""
    return fixtures.simulated_answers(_suite(spark, d))


def _sim(spark, d):
    """The predictor's log: answers with missing, failed and retried calls."""
    return fixtures.simulated_responses(_suite(spark, d))


def _results(spark, d):
    return evaluate.score(_suite(spark, d), _sim(spark, d), MODELS)


def _summary(spark, d):
    return evaluate.summarise(_results(spark, d))


def _pairs(spark, d):
    return fixtures.conversation_pairs(table(spark, d, "conversations"))


def _run_log(spark, d):
    return fixtures.run_log_from_events(table(spark, d, "events"))


def _gpu(spark, d):
    return fixtures.gpu_samples_from_events(table(spark, d, "events"))


# ---- corpus side ---------------------------------------------------------

def q_chatml_train(spark, d):
    resolved = prep.resolve_pairs(_pairs(spark, d))
    return prep.render_training(resolved).select("pair_id", "text")


def q_chatml_prompt(spark, d):
    users = table(spark, d, "conversations").where(F.col("role") == "user")
    return prep.render_prompt(users, user="text").select("conv_id", "turn", "prompt")


def q_chatml_multiturn(spark, d):
    return prep.render_conversations(table(spark, d, "conversations"))


def q_alias_resolve(spark, d):
    renamed = _pairs(spark, d).select(
        "pair_id", F.col("instruction").alias("prompt"), F.col("instruction").alias("question"),
        F.col("command").alias("completion"), F.col("conv_id").alias("input"))
    return prep.resolve_pairs(renamed)


def q_pairs_from_json(spark, d):
    """Pairs written as JSON lines under all accepted names, and read back."""
    path = scratch_path(spark, "pairs-json")
    fixtures.pair_lines(_pairs(spark, d)).write.text(path)
    return prep.resolve_pairs(read_pairs(spark, path, "json"))


def q_seq_budget(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = prep.truncate_tokens(docs, "text")
    return out.select("doc_id", "n_tokens", "over_budget",
                      F.size("kept_tokens").cast("bigint").alias("kept_n"),
                      F.md5(F.array_join("kept_tokens", " ")).alias("kept_md5"))


def q_train_plan(spark, d):
    plan = prep.training_plan(prep.resolve_pairs(_pairs(spark, d)))
    return plan.select("pair_id", "order_key", "rank", "step")


def q_train_order(spark, d):
    """The whole seeded order with rank and step."""
    plan = prep.training_plan(prep.resolve_pairs(_pairs(spark, d)), max_steps=None)
    return plan.select("pair_id", "order_key", "rank", "step")


def q_corpus_size(spark, d):
    corpus = prep.render_training(prep.resolve_pairs(_pairs(spark, d)))
    return corpus.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.sum(F.length("text")).cast("bigint").alias("n_chars"))


# ---- answer cleaning -----------------------------------------------------

def q_stop_truncate(spark, d):
    gen = fixtures.generations(_answers(spark, d))
    return gen.select(*KEYS, cut_at_stop("generation").alias("cut"))


def q_ask_last_line(spark, d):
    return _answers(spark, d).select(*KEYS, last_line("raw_prediction").alias("last_line"))


def q_clean_command(spark, d):
    return _answers(spark, d).select(*KEYS, clean_command("raw_prediction").alias("clean_prediction"))


# ---- metrics -------------------------------------------------------------

def _cleaned(spark, d):
    return evaluate.pair_with_responses(_suite(spark, d), _sim(spark, d), MODELS).withColumn(
        "clean_prediction", clean_command("raw_prediction"))


def q_token_counts(spark, d):
    return scoring.token_counts(_cleaned(spark, d), KEYS)


def q_ngram_overlap(spark, d):
    return scoring.ngram_overlap(_cleaned(spark, d), KEYS)


def q_exact_match(spark, d):
    return _results(spark, d).select(*KEYS, "em")


def q_token_f1(spark, d):
    return evaluate.score(_suite(spark, d), _sim(spark, d), MODELS, bleu=False).select(*KEYS, "f1")


def q_bleu4(spark, d):
    return _results(spark, d).select(*KEYS, "bleu4")


def q_single_line(spark, d):
    return _results(spark, d).select(*KEYS, F.col("single_line").cast("bigint").alias("single_line"))


def q_output_chars(spark, d):
    return _results(spark, d).select(*KEYS, "output_chars")


# ---- evaluation and reports ---------------------------------------------

def q_eval_grid(spark, d):
    return evaluate.grid(_suite(spark, d), MODELS).select(*KEYS)


def q_missing_default(spark, d):
    paired = evaluate.pair_with_responses(_suite(spark, d), _sim(spark, d), MODELS)
    return paired.select(*KEYS, "raw_prediction", "latency", "is_error")


def _dump(spark, d):
    """The predictor's log, written as JSON lines with failed, cut and retried calls, and read back."""
    path = scratch_path(spark, "response-dump")
    fixtures.response_dump(_suite(spark, d)).write.text(path)
    return read_responses(spark, path, "json")


def q_response_dump(spark, d):
    """Every (model, suite row) with the answer that the dump holds."""
    paired = evaluate.pair_with_responses(_suite(spark, d), _dump(spark, d), MODELS)
    return paired.select(*KEYS, "raw_prediction", "latency", "is_error")


def q_failed_calls(spark, d):
    return evaluate.failures(_dump(spark, d))


def q_suite_union(spark, d):
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("nl"))
    bench = table(spark, d, "benchmark").select(
        F.col("item_id").alias("id"), F.col("text").alias("nl"))
    with_gold = [df.withColumn("gold", fixtures.gold_of("nl")) for df in (docs, bench)]
    return evaluate.suite_union(("documents", with_gold[0]), ("benchmark", with_gold[1])).select(
        "suite", "id", "gold")


def q_sample_results(spark, d):
    return evaluate.sample_results(_results(spark, d))


def q_positional_results(spark, d):
    """Detail records of a suite whose files hold no ids: a sample's id is its place in its suite."""
    path = scratch_path(spark, "suite-no-ids")
    # A gzipped file is read by one task: as many ranges as a shuffle has partitions.
    ranges = _suite(spark, d).repartitionByRange("id").sortWithinPartitions("id").select("suite", "nl", "gold")
    with shuffle_files_go(spark):
        ranges.write.option("zlib.compress.level", report.GZIP_LEVEL).json(path, compression="gzip")
    suite = read_suite(spark, path, "json", positions=True)
    return evaluate.sample_results(evaluate.score(suite, fixtures.simulated_responses(suite), MODELS))


def q_suite_summary(spark, d):
    return _summary(spark, d)


def q_suite_summary_full(spark, d):
    """All seven published metrics, syntax validity included (rows only)."""
    return evaluate.summarise(evaluate.score(_suite(spark, d), _sim(spark, d), MODELS, check_syntax=True))


def q_model_compare(spark, d):
    return report.compare(_summary(spark, d), "base", "tuned")


#: What each suite's report shows, and the models' names in it.
TRACKS = {"suite_b": SHORT_REPORT}
LABELS = {"base": "simulated base", "tuned": "simulated tuned"}


def q_markdown_report(spark, d):
    shown = report.compare(_summary(spark, d), "base", "tuned", tracks=TRACKS)
    return report.markdown(shown, LABELS["base"], LABELS["tuned"])


_REPORTS: dict[tuple[str, str], str] = {}
#: Writes that a report's details are dealt into: the shuffle files of one lie beside the details, not those of all.
REPORT_SLICES = 3


def _written_report(spark, d):
    """Folder of the report of a table folder, published once a session: its parts are read by several queries."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _REPORTS:
        path = scratch_path(spark, "json-report")
        report.write_json(_results(spark, d), path, LABELS, "gzip", REPORT_SLICES)
        _REPORTS[key] = path
    return _REPORTS[key]


def q_json_report(spark, d):
    """The detail records, as read back from the report's files."""
    return report.read_json_report(spark, _written_report(spark, d))[1].select(*evaluate.RESULT_COLUMNS)


def q_json_summary(spark, d):
    """The summary, as read back from the report's files."""
    return report.read_json_report(spark, _written_report(spark, d))[0]


def q_json_models(spark, d):
    """The models of the report with their labels and sample counts."""
    path = _written_report(spark, d)
    samples = report.read_json_report(spark, path)[0].groupBy("model").agg(F.sum("num_samples").alias("num_samples"))
    return report.read_models(spark, path).join(samples, "model")


def q_syntax_valid(spark, d):
    cleaned = _cleaned(spark, d).select(*KEYS, "clean_prediction")
    return evaluate.with_syntax(cleaned, _sim(spark, d), MODELS)


def q_batch_predict(spark, d):
    users = table(spark, d, "conversations").where(F.col("role") == "user")
    prompts = prep.render_prompt(users, user="text").select("conv_id", "turn", "prompt")
    out = predict.run(prompts, predict.echo_user_predictor, "prompt", batch_size=8)
    return out.select("conv_id", "turn", "raw_prediction", "is_error", "latency")


# ---- telemetry -----------------------------------------------------------

def q_loss_convergence(spark, d):
    return telemetry.convergence(_run_log(spark, d))


def q_peak_memory(spark, d):
    return telemetry.peak_memory(_gpu(spark, d))


def q_peak_memory_by_label(spark, d):
    return telemetry.peak_memory(_gpu(spark, d), by=("run_id", "label"))


def q_log_tail(spark, d):
    return telemetry.tail(_run_log(spark, d))


# ---- streams -------------------------------------------------------------

def _stream(spark, d, name):
    """A table of the given folder as a stream, read where it lies."""
    schema = table(spark, d, name).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
            .option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{d.rstrip('/')}/{name}.parquet*"))


FILES_PER_BATCH = 64
#: Files of a table come in any order: no row of it is late.
STREAM_WATERMARK = "36500 days"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _drain(spark, stream, name, mode="append"):
    """Run a stream to the end of its input, state in RocksDB; where its output lies."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    out = scratch_path(spark, name)
    streaming.run_availablenow(stream, out, out + "-ckpt", mode=mode)
    return out


def q_stream_log_tail(spark, d):
    log = fixtures.run_log_from_events(_stream(spark, d, "events"))
    return spark.read.parquet(_drain(spark, log, "log-tail")).select("run_id", "step", "ts", "loss")


def q_stream_growing_log(spark, d):
    """The run log as files of JSON lines, followed by byte offsets."""
    src = scratch_path(spark, "growing-log")
    log = fixtures.run_log_from_events(table(spark, d, "events")).withColumn("ts", timefn.utc_instant("ts"))
    log.select(F.to_json(F.struct("*"), {"timestampFormat": streaming.LOG_TS_FORMAT}).alias("value")).write.text(src)
    records = streaming.json_records(streaming.tail_lines(spark, src, "part-*"))
    out = spark.read.parquet(_drain(spark, records, "growing-tail"))
    return out.select("run_id", "step", timefn.utc_wall("ts").alias("ts"), "loss")


def q_train_log_records(spark, d):
    """The run log as the trainer prints it, progress bars between, followed and parsed."""
    src = scratch_path(spark, "train-log")
    log = fixtures.run_log_from_events(table(spark, d, "events"))
    bar = F.when(F.col("step") % 3 == 0, F.lit("  3%|#         | 10/300 [00:12<05:50]\r")).otherwise(F.lit(""))
    entry = F.format_string("%s{'loss': %s, 'grad_norm': 0.5, 'learning_rate': 2e-05, 'epoch': %s}", bar, F.col("loss").cast("string"), F.col("step"))
    lines = log.select(F.explode(F.array(F.lit("==== step ===="), entry)).alias("value"))
    lines.write.text(src)
    records = streaming.train_log_records(streaming.tail_lines(spark, src, "part-*"))
    out = _drain(spark, records, "train-records")
    return spark.read.parquet(out).select("kind", F.col("epoch").cast("bigint").alias("step"), "loss", "grad_norm", "learning_rate")


def q_stream_eval(spark, d):
    """Answers stream in with the documents; the references are written once, by the join's key."""
    calls = fixtures.simulated_responses(fixtures.suite_from_documents(_stream(spark, d, "documents")))
    gold = scratch_path(spark, "gold")
    _suite(spark, d).select("suite", "id", "gold").repartition("suite", "id").write.parquet(gold)
    gold = spark.read.schema("suite string, id bigint, gold string").parquet(gold)
    out = scratch_path(spark, "running-eval")
    table_ = streaming.running_evaluation_table(calls, gold, out, out + "-ckpt")
    return streaming.finish_running(streaming.running_totals(table_.current()))


STREAM_WINDOW = "1 day"


def q_stream_telemetry(spark, d):
    samples = fixtures.gpu_samples_from_events(_stream(spark, d, "events")).withColumn("ts", timefn.utc_instant("ts"))
    windows = streaming.telemetry_windows(samples, STREAM_WINDOW, STREAM_WATERMARK, by=("label",))
    out = _drain(spark, windows, "gpu-windows", mode="update")
    return streaming.latest(spark, out, ["window_start", "window_end", "label"]).select(
        timefn.utc_wall("window_start").alias("window_start"),
        timefn.utc_wall("window_end").alias("window_end"),
        "label", "n_samples", "peak_reserved_bytes")


def q_stream_late_rows(spark, d):
    """Samples arrive a file at a time in no order of time: rows in windows and rows counted as late are all rows."""
    src = scratch_path(spark, "samples-by-arrival")
    samples = fixtures.gpu_samples_from_events(table(spark, d, "events")).withColumn("ts", timefn.utc_instant("ts"))
    samples.repartition(4, F.xxhash64("ts", "run_id")).write.parquet(src)
    stream = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = scratch_path(spark, "late-windows")
    tables = streaming.window_tables(stream, out, out + "-ckpt", "1 day", "10 days", by=("label",))
    counted = (tables.current().select("label", F.col("n_samples").alias("n"))
               .unionByName(tables.late.current().select("label", F.col("n_late").alias("n"))))
    return counted.groupBy("label").agg(F.sum("n").alias("n_events"))


def q_stream_loss_windows(spark, d):
    log = fixtures.run_log_from_events(_stream(spark, d, "events")).withColumn("ts", timefn.utc_instant("ts"))
    out = _drain(spark, streaming.loss_windows(log, STREAM_WINDOW, STREAM_WATERMARK), "loss-windows", mode="update")
    return streaming.latest(spark, out, ["window_start", "window_end", "run_id"]).select(
        timefn.utc_wall("window_start").alias("window_start"),
        timefn.utc_wall("window_end").alias("window_end"),
        "run_id", "n_logged", "mean_loss", "last_loss")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "chatml_train": q_chatml_train,
    "chatml_prompt": q_chatml_prompt,
    "chatml_multiturn": q_chatml_multiturn,
    "alias_resolve": q_alias_resolve,
    "pairs_from_json": q_pairs_from_json,
    "stop_truncate": q_stop_truncate,
    "ask_last_line": q_ask_last_line,
    "clean_command": q_clean_command,
    "seq_budget": q_seq_budget,
    "token_counts": q_token_counts,
    "ngram_overlap": q_ngram_overlap,
    "exact_match": q_exact_match,
    "token_f1": q_token_f1,
    "bleu4": q_bleu4,
    "single_line": q_single_line,
    "output_chars": q_output_chars,
    "eval_grid": q_eval_grid,
    "missing_default": q_missing_default,
    "response_dump": q_response_dump,
    "failed_calls": q_failed_calls,
    "suite_union": q_suite_union,
    "sample_results": q_sample_results,
    "positional_results": q_positional_results,
    "suite_summary": q_suite_summary,
    "suite_summary_full": q_suite_summary_full,
    "model_compare": q_model_compare,
    "markdown_report": q_markdown_report,
    "json_report": q_json_report,
    "json_summary": q_json_summary,
    "json_models": q_json_models,
    "train_plan": q_train_plan,
    "train_order": q_train_order,
    "corpus_size": q_corpus_size,
    "loss_convergence": q_loss_convergence,
    "peak_memory": q_peak_memory,
    "peak_memory_by_label": q_peak_memory_by_label,
    "log_tail": q_log_tail,
    "syntax_valid": q_syntax_valid,
    "batch_predict": q_batch_predict,
    "stream_log_tail": q_stream_log_tail,
    "stream_growing_log": q_stream_growing_log,
    "train_log_records": q_train_log_records,
    "stream_eval": q_stream_eval,
    "stream_telemetry": q_stream_telemetry,
    "stream_late_rows": q_stream_late_rows,
    "stream_loss_windows": q_stream_loss_windows,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q_suite_summary(spark, sf_dir)
