"""Write/read round trips for the readers and the corpus sink (S1-S4, K1)."""

import datetime as dt
import json
import os

import pytest

from cmdeval import streaming
from cmdeval.constants import COMMAND_ALIASES, INSTRUCTION_ALIASES
from cmdeval.operators import evaluate, prep
from cmdeval.session import scratch_path
from cmdeval.sources import (read_gpu_samples, read_pairs, read_responses, read_run_log, read_suite,
                             write_corpus)


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write_lines(path, recs):
    os.makedirs(_local(path), exist_ok=True)
    with open(os.path.join(_local(path), "part-0.json"), "w") as f:
        for r in recs:
            f.write(json.dumps(r) + "\n")


def test_pairs_json_csv_parquet(spark):
    base = scratch_path(spark, "pairs")
    recs = [{"pair_id": 1, "question": " list files ", "response": "ls"},
            {"pair_id": 2, "question": "disk", "response": None}]
    _write_lines(base + "/json", recs)
    got = prep.resolve_pairs(read_pairs(spark, base + "/json", "json")).collect()
    assert [(r.pair_id, r.instruction, r.command) for r in got] == [(1, "list files", "ls")]
    df = spark.createDataFrame([(1, "a\nb", "echo 'x'")], "pair_id long, prompt string, completion string")
    df.write.option("header", True).option("escape", '"').csv(base + "/csv")
    df.write.parquet(base + "/pq")
    for path, fmt in ((base + "/csv", "csv"), (base + "/pq", None)):
        r = prep.resolve_pairs(read_pairs(spark, path, fmt)).collect()[0]
        assert (r.pair_id, r.instruction, r.command) == (1, "a\nb", "echo 'x'")


def test_suite_and_responses_declared_schema(spark):
    base = scratch_path(spark, "suite")
    _write_lines(base + "/suite", [{"suite": "a", "id": 1, "nl": "x", "gold": "pwd", "extra": 5}])
    s = read_suite(spark, base + "/suite", "json")
    assert s.columns == ["suite", "id", "nl", "gold"] and s.schema["id"].dataType.typeName() == "long"
    _write_lines(base + "/resp", [{"model": "m", "suite": "a", "id": 1, "raw_prediction": "pwd", "latency": 1}])
    r = read_responses(spark, base + "/resp", "json").collect()[0]
    assert (r.latency, r.raw_prediction, r.is_error, r.ts, r.error) == (1.0, "pwd", False, None, None)


@pytest.mark.parametrize("inst", INSTRUCTION_ALIASES)
@pytest.mark.parametrize("cmd", COMMAND_ALIASES)
def test_pairs_json_under_every_alias(spark, inst, cmd):
    base = scratch_path(spark, "alias")
    _write_lines(base, [{inst: " list ", cmd: "ls", "pair_id": 7, "extra": {"a": [1]}}, {inst: 5, cmd: None}, {"other": 1}])
    got = prep.resolve_pairs(read_pairs(spark, base, "json")).collect()
    assert [(r.pair_id, r.instruction, r.command) for r in got] == [(7, "list", "ls")]
    kept = prep.resolve_pairs(read_pairs(spark, base, "json").where("instruction = '5'"), null_as_text=True).collect()
    assert [(r.instruction, r.command) for r in kept] == [("5", "None")] and kept[0].pair_id is not None


def test_pairs_json_mixed_names_order_and_failures(spark):
    base = scratch_path(spark, "mixed")
    _write_lines(base, [{"question": "q", "input": "i", "response": "r", "output": "o"}, {"prompt": None, "question": "q", "command": "c"},
                        {"instruction": "a\nb", "completion": "x"}])
    rows = sorted((r.instruction or "", r.command) for r in read_pairs(spark, base, "json").collect())
    assert rows == [("", "c"), ("a\nb", "x"), ("i", "o")]  # a name that a record has counts, null or not
    none = scratch_path(spark, "none")
    _write_lines(none, [{"prompt": "p", "answer": "a"}])
    with pytest.raises(ValueError, match="command"):
        read_pairs(spark, none, "json")
    _write_lines(empty := scratch_path(spark, "empty"), [])
    assert read_pairs(spark, empty, "json").count() == 0
    with open(os.path.join(_local(base), "part-1.json"), "w") as f:
        f.write('{"prompt": "cut\n\n')
    assert read_pairs(spark, base, "json", malformed="drop").where("instruction is not null").count() == 2
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_pairs(spark, base, "json").collect()


def test_pairs_json_array_file(spark):
    base = scratch_path(spark, "array")
    os.makedirs(_local(base))
    with open(os.path.join(_local(base), "a.json"), "w") as f:
        json.dump([{"prompt": "p1", "output": "o1"}, {"question": "p2", "command": "o2"}], f, indent=2)
    got = read_pairs(spark, base, "json", multi_line=True).collect()
    assert sorted((r.instruction, r.command) for r in got) == [("p1", "o1"), ("p2", "o2")]


def test_pairs_csv_with_line_breaks_and_quotes(spark):
    base = scratch_path(spark, "csv")
    os.makedirs(_local(base))
    with open(os.path.join(_local(base), "a.csv"), "w") as f:
        f.write('pair_id,prompt,response\n1,"a\nb ""x"", c","echo \\ y"\n2,d,e\n')
    got = prep.resolve_pairs(read_pairs(spark, base, "csv")).collect()
    assert [(r.pair_id, r.instruction, r.command) for r in got] == [(1, 'a\nb "x", c', "echo \\ y"), (2, "d", "e")]


DUMP = [
    {"model": "m", "suite": "s", "id": 1, "raw_prediction": "", "latency": 0.0, "is_error": True, "ts": "2024-01-01T00:00:00Z"},
    {"model": "m", "suite": "s", "id": 1, "raw_prediction": "ls -la", "latency": 2.0, "ts": "2024-01-01T00:01:00Z"},
    {"model": "m", "suite": "s", "id": 2, "error": "timeout"},
    {"model": "m", "suite": "s", "id": 3, "response": " pwd ", "latency": 1.5},
    {"model": "m", "suite": "s", "id": 4, "latency": 1.5},
    {"model": "m", "suite": "s", "id": 5, "raw_prediction": "df", "latency": "slow"},
]


def test_failures_in_a_json_dump_survive_the_reader(spark):
    """A failed call and then an answer for one key, read from files, scores the answer."""
    base = scratch_path(spark, "dump")
    _write_lines(base, DUMP)
    with open(os.path.join(_local(base), "part-1.json"), "w") as f:
        f.write('{"model": "m", "suite": "s", "id": 6, "raw_pred\n\nnot json\n{"model":"m","suite":"s","id":3,"raw_prediction":"x')
    calls = read_responses(spark, base, "json")
    assert sorted((r.id or 0, r.is_error, r.error or "") for r in calls.collect()) == [
        (0, True, "malformed"), (1, False, ""), (1, True, "flagged"), (2, True, "timeout"), (3, False, ""), (3, True, "malformed"),
        (4, True, "no text"), (5, True, "malformed"), (6, True, "malformed")]
    # Whether a line is malformed doesn't hang on the columns that are read.
    assert calls.where("id = 5").select("is_error").collect()[0].is_error
    suite = spark.createDataFrame([("s", i, "q", "ls -la" if i == 1 else "pwd") for i in range(1, 8)], "suite string, id long, nl string, gold string")
    rows = {r.id: r for r in evaluate.score(suite, calls, ["m"]).collect()}
    assert (rows[1].raw_prediction, rows[1].em, rows[1].latency, rows[1].is_error) == ("ls -la", 1.0, 2.0, False)
    assert (rows[3].raw_prediction, rows[3].em, rows[3].is_error) == ("pwd", 1.0, False)
    assert all((rows[i].raw_prediction, rows[i].latency, rows[i].is_error) == ("", 0.0, True) for i in (2, 4, 5, 6, 7))
    kinds = {(r.reason, r.n_calls) for r in evaluate.failures(calls).where("model = 'm'").collect()}
    assert kinds == {("malformed", 3), ("flagged", 1), ("timeout", 1), ("no text", 1)}


def test_failures_in_csv_and_parquet_dumps(spark):
    base = scratch_path(spark, "csvdump")
    os.makedirs(_local(base))
    with open(os.path.join(_local(base), "a.csv"), "w") as f:
        f.write('id,model,suite,raw_prediction,latency,is_error\n1,m,s,"a\nb",1.5,\n2,m,s,x,slow,false\n3,m,s,,0,true\n4,m,s,y\n')
    got = {r.id: r for r in read_responses(spark, base, "csv").collect()}
    assert (got[1].raw_prediction, got[1].latency, got[1].is_error) == ("a\nb", 1.5, False)
    assert (got[2].error, got[3].error, got[4].error) == ("malformed", "flagged", "malformed")
    df = spark.createDataFrame([("m", "s", 1, "ls", 1.0), ("m", "s", 2, None, 1.0)],
                               "model string, suite string, id long, raw_prediction string, latency double")
    df.write.parquet(base + "-pq")
    assert {r.id: r.error for r in read_responses(spark, base + "-pq").collect()} == {1: None, 2: "no text"}


def test_run_log_and_gpu_samples(spark):
    base = scratch_path(spark, "logs")
    _write_lines(base + "/log", [{"run_id": "r", "step": 10, "ts": "2024-01-01T00:00:10Z", "loss": 0.5}])
    log = read_run_log(spark, base + "/log", "json").collect()[0]
    assert (log.step, log.loss) == (10, 0.5)
    spark.createDataFrame([("r", dt.datetime(2024, 1, 1), "Initial State", 5, 10)],
                          "run_id string, ts timestamp, label string, reserved_bytes long, total_bytes long") \
        .write.parquet(base + "/gpu")
    g = read_gpu_samples(spark, base + "/gpu").collect()[0]
    assert (g.label, g.reserved_bytes) == ("Initial State", 5)


def test_write_corpus_round_trip(spark):
    path = scratch_path(spark, "corpus")
    pairs = spark.createDataFrame([(1, "list", "ls")], "pair_id long, instruction string, command string")
    corpus = prep.render_training(pairs)
    write_corpus(corpus, path)
    back = spark.read.parquet(path).collect()[0]
    assert back.text.startswith("<|im_start|>system\n") and back.text.endswith("<|im_start|>assistant\nls<|im_end|>\n")


def test_tail_log_filters(spark):
    base = scratch_path(spark, "tail")
    recs = [{"run_id": r, "step": s, "ts": "2024-01-01T00:00:00.000000Z", "loss": 1.0}
            for r in ("a", "b") for s in range(5)]
    _write_lines(base + "/src", recs)
    stream = streaming.tail_log(spark, base + "/src", run_ids=["a"], min_step=3)
    streaming.run_availablenow(stream, base + "/out", base + "/ck")
    got = sorted((r.run_id, r.step) for r in spark.read.parquet(base + "/out").collect())
    assert got == [("a", 3), ("a", 4)]
