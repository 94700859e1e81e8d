"""Time columns (IDs C9, C10, C11, C16).

Epoch milliseconds are the message time (``date`` field). Batch outputs use
``TIMESTAMP_NTZ`` computed without any session time zone, so the result is
the UTC wall clock whatever the session zone is. Streams need ``TIMESTAMP``
(``withWatermark`` rejects NTZ), for which ``timestamp_millis`` is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def millis_to_ntz(col) -> Column:
    """C9, zone-free: epoch ms -> TIMESTAMP_NTZ (UTC wall clock)."""
    return F.expr(EPOCH_NTZ) + _c(col) * F.expr("INTERVAL '0.001' SECOND")


def millis_to_ts(col) -> Column:
    """C9 for streams: epoch ms -> TIMESTAMP."""
    return F.timestamp_millis(_c(col))


def to_event_time(col, time_type: str = "timestamp_ntz") -> Column:
    if time_type == "timestamp_ntz":
        return millis_to_ntz(col)
    if time_type == "timestamp":
        return millis_to_ts(col)
    raise ValueError(f"time_type must be timestamp_ntz or timestamp, not {time_type!r}")


def ntz_to_millis(col) -> Column:
    """TIMESTAMP_NTZ -> epoch ms, zone-free (sub-millisecond digits dropped)."""
    return F.expr(f"timestampdiff(MILLISECOND, {EPOCH_NTZ}, {_sql(col)})")


def _sql(col) -> str:
    if isinstance(col, str):
        return f"`{col}`"
    raise TypeError("ntz_to_millis takes a column name")


def index_name(day_col, prefix: str = "logcount-") -> Column:
    """C10 + C11: daily index name ``logcount-yyyy.MM.dd``."""
    return F.concat(F.lit(prefix), F.date_format(_c(day_col), "yyyy.MM.dd"))


def write_time() -> Column:
    """Processing time of the write."""
    return F.current_timestamp()
