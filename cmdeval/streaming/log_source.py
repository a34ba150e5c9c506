"""``tail -f`` as a stream: lines added to the files of a folder, each once.

A streaming data source keeps a byte offset per file in the query's checkpoint. A
micro-batch reads what lies between two offsets, in splits that tasks share; the end
is always behind a line break, so a line that is still being written waits until it
is whole. After a restart the stored offsets name the same bytes again. A file that
has become shorter counts as begun anew, as with ``tail -f``. Files are read through
Arrow's file systems, so a folder may be local, shared, or in an object store.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import ensure_package_on_workers
from ..sources.schemas import RUN_LOG_SCHEMA

SPLIT_BYTES = 32 << 20
READ_BYTES = 1 << 20
BATCH_LINES = 10_000


def file_system(path: str):
    """(file system, root) of a path or URI."""
    from pyarrow import fs
    if "://" in path or path.startswith("file:"):
        scheme, _, rest = path.partition(":")
        return fs.FileSystem.from_uri(f"file:///{rest.lstrip('/')}" if scheme == "file" else path)
    return fs.LocalFileSystem(), path


class Span(InputPartition):
    """Bytes ``lo`` to ``stop`` of a file: the lines that begin there. ``end`` closes the last of them; ``inner``
    says that ``lo`` need not begin a line."""

    def __init__(self, file: str, lo: int, stop: int, end: int, inner: bool):
        super().__init__(0)
        self.file, self.lo, self.stop, self.end, self.inner = file, lo, stop, end, inner


def spans(file: str, lo: int, end: int, split: int) -> list[Span]:
    return [Span(file, at, min(at + split, end), end, at > lo) for at in range(lo, end, split)]


def last_break(handle, size: int) -> int:
    """The offset behind the last line break of a file, 0 without one."""
    at = size
    while at > 0:
        lo = max(0, at - READ_BYTES)
        handle.seek(lo)
        found = handle.read(at - lo).rfind(b"\n")
        if found >= 0:
            return lo + found + 1
        at = lo
    return 0


def lines_of(handle, span: Span) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that begin in a span."""
    at = span.lo
    if span.inner:  # the line that holds the byte before belongs to the span before
        at -= 1
        while at < span.end:
            handle.seek(at)
            data = handle.read(min(READ_BYTES, span.end - at))
            found = data.find(b"\n")
            if found >= 0:
                at += found + 1
                break
            at += len(data)
    handle.seek(at)
    read, rest = at, b""
    while at < span.stop:
        data = handle.read(min(READ_BYTES, span.end - read))
        if not data:
            return
        read += len(data)
        *whole, rest = (rest + data).split(b"\n")
        for line in whole:
            if at >= span.stop:
                return
            yield at, line
            at += len(line) + 1


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path, self.pattern = options["path"], options.get("pattern", "*")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.ends: dict[str, tuple[int, int]] = {}  # file -> its size when last looked at, and the end found

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs
        system, root = file_system(self.path)
        for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
            if info.type != fs.FileType.File or info.base_name[0] in "._" or not fnmatch.fnmatch(info.base_name, self.pattern):
                continue
            if self.ends.get(info.path, (None,))[0] != info.size:
                with system.open_input_file(info.path) as handle:
                    self.ends[info.path] = info.size, last_break(handle, info.size)
        return {f: end for f, (_, end) in sorted(self.ends.items())}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        out = []
        for file, stop in end.items():
            lo = start.get(file, 0)
            out += spans(file, lo if lo <= stop else 0, stop, self.split)
        return out

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, _ = file_system(self.path)
        names = ["file", "offset", "line"]
        with system.open_input_file(partition.file) as handle:
            offsets, texts = [], []
            for at, line in lines_of(handle, partition):
                offsets.append(at)
                texts.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                if len(texts) == BATCH_LINES:
                    yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(texts)), pa.array(offsets, pa.int64()), pa.array(texts)], names)
                    offsets, texts = [], []
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([partition.file] * len(texts)), pa.array(offsets, pa.int64()), pa.array(texts)], names)

    def commit(self, end: dict) -> None:
        pass


class GrowingLog(DataSource):
    """Options: ``path`` (a folder), ``pattern`` (of file names), ``split_bytes``."""

    @classmethod
    def name(cls) -> str:
        return "growing_log"

    def schema(self) -> str:
        return "file string, offset bigint, line string"

    def streamReader(self, schema: T.StructType) -> GrowingLogReader:
        return GrowingLogReader(self.options)


def tail_lines(spark: SparkSession, source_dir: str, pattern: str = "*", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stream of (file, offset, line): the whole lines of a folder's files as they are added."""
    ensure_package_on_workers(spark)
    spark.dataSource.register(GrowingLog)
    return (spark.readStream.format("growing_log").option("pattern", pattern).option("split_bytes", split_bytes)
            .load(source_dir))


def json_records(lines: DataFrame, schema: T.StructType = RUN_LOG_SCHEMA) -> DataFrame:
    """Records of JSON lines; a line that isn't one is left out."""
    fields = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = F.from_json("line", fields, {"columnNameOfCorruptRecord": "_bad"}).alias("r")
    return lines.select(parsed).where("r._bad IS NULL").select("r.*").drop("_bad")


# What the trainer prints, a dictionary for each logged step and closing lines.
STEP_METRICS = ("loss", "grad_norm", "learning_rate", "epoch", "train_runtime", "train_loss")
CLOSING = {"train_runtime": r"^Runtime: (\S+) seconds$", "train_loss": r"^Train loss: (\S+)$",
           "peak_gb": r"^Peak VRAM used: (\S+) GB / \S+ GB"}


def train_log_records(lines: DataFrame, line: str = "line") -> DataFrame:
    """The trainer's plain log: the lines that hold metrics, with a column for each (null where a line has none).

    A step's dictionary may stand behind a progress bar on its line. ``kind`` is ``step`` where there is a loss,
    else ``summary``. Other lines are left out; numbers that can't be read are null.
    """
    last = F.regexp_extract(F.col(line), r"(\{'[^{}]*\})\s*$", 1)

    def value(name: str) -> Column:
        found = F.regexp_extract(last, rf"'{name}': '?([^,}}']+)", 1)
        if name in CLOSING:
            found = F.when(found == "", F.regexp_extract(F.col(line), CLOSING[name], 1)).otherwise(found)
        return F.when(found != "", found).try_cast("double")

    metrics = {m: value(m) for m in (*STEP_METRICS, "peak_gb")}
    metrics["peak_gb"] = F.regexp_extract(F.col(line), CLOSING["peak_gb"], 1).try_cast("double")
    out = lines.withColumns(metrics)
    any_metric = F.coalesce(*[F.col(m) for m in metrics]).isNotNull()
    return out.where(any_metric).withColumn("kind", F.when(F.col("loss").isNotNull(), F.lit("step")).otherwise(F.lit("summary")))
