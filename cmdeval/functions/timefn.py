"""Wall-clock (TIMESTAMP_NTZ) <-> instant helpers that ignore the session zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_instant(ntz: Column | str) -> Column:
    """A wall-clock (NTZ) time read as UTC, as an instant; the session zone does not matter."""
    c = F.col(ntz) if isinstance(ntz, str) else ntz
    # cast() reads the wall time in the session zone; shift it back by that zone's offset.
    return F.from_utc_timestamp(c.cast("timestamp"), F.current_timezone())


def utc_wall(instant: Column | str) -> Column:
    """Inverse of ``utc_instant``: the UTC wall-clock time of an instant."""
    c = F.col(instant) if isinstance(instant, str) else instant
    return F.to_utc_timestamp(c, F.current_timezone()).cast("timestamp_ntz")


def as_instant(df: DataFrame, col: str) -> Column:
    """``col`` as an instant: wall-clock columns are read as UTC, instants pass through."""
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        return utc_instant(col)
    return F.col(col).cast("timestamp")
