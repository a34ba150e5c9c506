"""Following files that grow: every whole line once, also after a restart."""

import io
import json
import os

from cmdeval import streaming
from cmdeval.streaming import log_source


def drain(spark, src, out, **kw):
    streaming.run_availablenow(streaming.tail_lines(spark, src, **kw), out, out + "-ck")
    return sorted((os.path.basename(r.file), r.offset, r.line) for r in spark.read.parquet(out).collect())


def append(path, data):
    with open(path, "ab") as f:
        f.write(data)


def test_lines_added_to_a_file_arrive_once(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src + "/run")
    append(src + "/run/a.log", "one\nzwei é\r\npart".encode())
    append(src + "/b.log", b"")
    append(src + "/_hidden.log", b"never\n")
    first = [("a.log", 0, "one"), ("a.log", 4, "zwei é")]
    assert drain(spark, src, out, pattern="*.log") == first
    assert drain(spark, src, out, pattern="*.log") == first  # restart, nothing new
    append(src + "/run/a.log", b"ial\n\nlast")  # the held-back line is completed
    append(src + "/b.log", b"b1\n")
    append(src + "/c.txt", b"another pattern\n")
    second = first + [("a.log", 13, "partial"), ("a.log", 21, ""), ("b.log", 0, "b1")]
    assert drain(spark, src, out, pattern="*.log") == sorted(second)
    with open(src + "/b.log", "wb") as f:  # begun anew, shorter
        f.write(b"n\n")
    assert drain(spark, src, out, pattern="*.log") == sorted([*second, ("b.log", 0, "n")])


def test_splits_share_lines_without_loss_or_repeat(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src)
    lines = ["x" * (i * 37 % 200) for i in range(400)]
    append(src + "/a.log", ("\n".join(lines) + "\n").encode())
    got = drain(spark, src, out, split_bytes=101)
    assert [line for _, _, line in got] == lines


def test_every_split_size_gives_the_same_lines():
    data = b"\n\nab\nc\n" + b"long" * 30 + b"\nend\n"
    want = list(log_source.lines_of(io.BytesIO(data), log_source.Span("f", 0, len(data), len(data), False)))
    assert b"".join(line + b"\n" for _, line in want) == data and all(data[at:].startswith(line + b"\n") for at, line in want)
    for split in range(1, len(data) + 1):
        got = [x for s in log_source.spans("f", 0, len(data), split) for x in log_source.lines_of(io.BytesIO(data), s)]
        assert got == want, split
    assert log_source.last_break(io.BytesIO(b"no break"), 8) == 0
    assert log_source.last_break(io.BytesIO(data + b"tail"), len(data) + 4) == len(data)


def test_offsets_of_a_longer_history():
    reader = log_source.GrowingLogReader({"path": "/nowhere-at-all"})
    assert reader.latestOffset() == {}
    cut = lambda a, b: [(s.file, s.lo, s.end) for s in reader.partitions(a, b)]
    assert cut({"f": 3}, {"f": 9, "g": 2}) == [("f", 3, 9), ("g", 0, 2)]
    assert cut({"f": 9}, {"f": 9}) == [] and cut({"f": 9}, {"f": 4}) == [("f", 0, 4)]


def test_json_and_trainer_lines(spark):
    rec = {"run_id": "r", "step": 3, "ts": "2024-01-01T00:00:00.000000Z", "loss": 0.5}
    lines = spark.createDataFrame([(json.dumps(rec),), ("{cut",), ('{"run_id": "r", "step": "x"}',)], "line string")
    got = streaming.json_records(lines).collect()
    assert [(r.run_id, r.step, r.loss) for r in got] == [("r", 3, 0.5)]
    text = ["Step 4: Training", "{'loss': 2.5, 'grad_norm': 1e-3, 'learning_rate': 2e-05, 'epoch': 0.1}",
            " 10%|#  | 30/300 [00:36<05:27]\r{'loss': 1.25, 'grad_norm': nan, 'learning_rate': 0.0, 'epoch': 0.2}",
            "{'train_runtime': 12.5, 'train_loss': 1.5, 'epoch': 1.0}", "Peak VRAM used: 3.25 GB / 15.0 GB (21.67%)",
            "Runtime: 12.50 seconds", "Train loss: N/A", "Train loss: 1.5", "{'loss': oops}", "{'other': 1}", ""]
    rows = streaming.train_log_records(spark.createDataFrame([(t,) for t in text], "line string")).collect()
    got = [(r.kind, r.loss, r.learning_rate, r.epoch, r.train_runtime, r.train_loss, r.peak_gb) for r in rows]
    assert got == [("step", 2.5, 2e-05, 0.1, None, None, None), ("step", 1.25, 0.0, 0.2, None, None, None),
                   ("summary", None, None, 1.0, 12.5, 1.5, None), ("summary", None, None, None, None, None, 3.25),
                   ("summary", None, None, None, 12.5, None, None), ("summary", None, None, None, None, 1.5, None)]
    assert rows[0].grad_norm == 1e-3 and rows[1].grad_norm != rows[1].grad_norm
