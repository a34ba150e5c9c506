"""Shell syntax validity (``bash -n``), checked once per distinct command."""

from __future__ import annotations

import functools
import os
import selectors
import subprocess
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SYNTAX_TIMEOUT_SEC
from ..session import ensure_package_on_workers
from .bags import slices


def _child_env() -> dict[str, str]:
    """Inherited environment minus start-up files and exported functions."""
    return {k: v for k, v in os.environ.items()
            if k not in ("BASH_ENV", "ENV") and not k.startswith("BASH_FUNC_")}


#: What the parser says of a command.
ARGUMENT_BYTES = 100_000
ACCEPTED, REJECTED, TIMED_OUT, NOT_RUN = "accepted", "rejected", "timed out", "not run"


def parse_outcome(command: str, timeout: float = SYNTAX_TIMEOUT_SEC, env: dict | None = None) -> str:
    """What a parse-only shell makes of ``command``; one too long for an argument goes to its standard input."""
    data = command.encode("utf-8", "replace")
    if b"\0" in data:
        return NOT_RUN
    given = ["-c", command] if len(data) < ARGUMENT_BYTES else []
    try:
        parser = subprocess.Popen(["bash", "-n", *given], stdin=subprocess.PIPE, stdout=subprocess.DEVNULL,
                                  stderr=subprocess.DEVNULL, env=_child_env() if env is None else env)
    except OSError:
        return NOT_RUN
    with parser:
        try:
            parser.communicate(None if given else data, timeout)
        except subprocess.TimeoutExpired:
            parser.kill()
            return TIMED_OUT
    return ACCEPTED if parser.returncode == 0 else REJECTED


#: Parses the commands that lie on its standard input, each ended by a NUL, and prints a digit for each. ``set -n`` stands
#: before a command in the text that is read, so nothing of it is run; ``local -`` takes that option back. Up to 20 commands
#: share a subshell, which ends at one that is rejected and tells by its status how many it has seen.
PARSER = r"""mapfile -d '' -t commands
parse() { local -; eval $'set -n\n'"${commands[i]}"; }
next=0
while ((next < ${#commands[@]})); do
  (for ((i = next; i < ${#commands[@]} && i < next + 20; i++)); do
     if parse; then printf 1; else printf 0; exit $((41 + i - next)); fi
   done
   exit $((40 + i - next)))
  seen=$(($? - 40))
  ((seen >= 1 && seen <= 20)) || exit
  ((next += seen))
done"""


def _digits(commands: list[bytes], timeout: float, env: dict) -> bytes:
    """What one shell prints for the commands, up to one that ends it or takes longer than ``timeout``."""
    held, told = os.memfd_create("commands"), b""
    try:
        with os.fdopen(os.dup(held), "wb") as f:
            f.writelines(c + b"\0" for c in commands)
        os.lseek(held, 0, os.SEEK_SET)
        try:
            parser = subprocess.Popen(["bash", "-c", PARSER], stdin=held, stdout=subprocess.PIPE,
                                      stderr=subprocess.DEVNULL, env=env)
        except OSError:
            return told
        with parser, selectors.DefaultSelector() as ready:
            ready.register(parser.stdout, selectors.EVENT_READ)
            while ready.select(timeout) and (some := os.read(parser.stdout.fileno(), 1 << 16)):
                told += some
            parser.kill()
    finally:
        os.close(held)
    return told


def parse_outcomes(commands: list[str], timeout: float = SYNTAX_TIMEOUT_SEC, env: dict | None = None) -> list[str]:
    """``parse_outcome`` of every command, many to a shell.

    Parsed alone are commands that end the shell or hold it up, those with ``<<`` and rejected ones with ``[[``: of
    these, ``bash -n -c`` and ``eval`` don't always say the same.
    """
    env = _child_env() if env is None else env
    data = [c.encode("utf-8", "replace") for c in commands]
    out = [NOT_RUN] * len(commands)
    todo, alone = [], []
    for i, c in enumerate(data):
        if b"\0" in c:
            continue
        if c[:1] in (b"-", b"+") and len(c) < ARGUMENT_BYTES:
            out[i] = REJECTED  # as an argument it is an option, which leaves ``-c`` without a command
        else:
            (alone if b"<<" in c else todo).append(i)
    while todo:
        told = _digits([data[i] for i in todo], timeout, env)
        for i, digit in zip(todo, told):
            out[i] = ACCEPTED if digit == ord("1") else REJECTED
            if out[i] == REJECTED and b"[[" in data[i]:
                alone.append(i)
        alone += todo[len(told):len(told) + 1]
        todo = todo[len(told) + 1:]
    for i in alone:
        out[i] = parse_outcome(commands[i], timeout, env)
    return out


#: Commands and bytes that a shell is given at once; a longer command has one of its own.
SLICE_COMMANDS, SLICE_BYTES = 256, 1 << 20


def _check_batches(batches: Iterator[pa.RecordBatch], timeout: float, parallelism: int) -> Iterator[pa.RecordBatch]:
    env = _child_env()

    def check(cmds: pa.Array) -> list[bool]:
        return [o == ACCEPTED for o in parse_outcomes(cmds.to_pylist(), timeout, env)]

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for batch in batches:
            cmds = batch.column(0)
            parts = [cmds.slice(a, b - a) for a, b in slices(cmds, size=SLICE_BYTES, rows=SLICE_COMMANDS)]
            for part, ok in zip(parts, pool.map(check, parts)):
                yield pa.RecordBatch.from_arrays([part, pa.array(ok, pa.bool_())], names=["_cmd", "_ok"])


def verdicts(commands: DataFrame, col: str = "clean_prediction", out: str = "syntax_valid",
             timeout: float = SYNTAX_TIMEOUT_SEC, parallelism: int = 4) -> DataFrame:
    """(command, verdict) for the distinct non-null commands of ``commands``.

    ``distinct()`` combines map-side (a command that fills a third of the rows
    is one row after it); a spread by command over all tasks keeps the parsers
    on all cores; an Arrow-batched worker starts one parser per slice of
    commands, a few at a time, and holds those slices as Python strings.
    """
    spark = commands.sparkSession
    ensure_package_on_workers(spark)
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions", "1")))
    cmds = (commands.select(F.col(col).alias("_cmd")).where(F.col("_cmd").isNotNull()).distinct()
            .repartition(tasks, "_cmd"))
    fn = functools.partial(_check_batches, timeout=timeout, parallelism=parallelism)
    return (cmds.mapInArrow(fn, schema="_cmd string, _ok boolean")
            .select(F.col("_cmd").alias(col), F.col("_ok").alias(out)))


def attach(df: DataFrame, checked: DataFrame, col: str = "clean_prediction",
           out: str = "syntax_valid") -> DataFrame:
    """Join verdicts back by the command's SHA-256, so that its text is no join key and the verdicts' side holds none
    (adaptive execution splits a hot command); a command without a verdict, or NULL, counts as invalid."""
    keyed = checked.select(F.sha2(col, 256).alias("_key"), F.col(out).alias("_ok"))
    return (df.withColumn("_key", F.sha2(col, 256)).join(keyed, on="_key", how="left")
            .select(col, *[c for c in df.columns if c not in (col, out)], F.coalesce(F.col("_ok"), F.lit(False)).alias(out)))
