"""Epoch-millisecond time as UTC columns that do not depend on the session time zone.

Wall-clock columns are TIMESTAMP_NTZ in UTC. All arithmetic is on integers; text that is not an
integer, and instants outside the years 1 to 9999, give NULL instead of failing the job.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
FIRST_MS, LAST_MS = -62135596800000, 253402300799999


def _millis_sql(name: str) -> str:
    value = f"try_cast(`{name}` AS BIGINT)"
    return f"CASE WHEN {value} BETWEEN {FIRST_MS} AND {LAST_MS} THEN {value} END"


def millis(name: str) -> Column:
    """Epoch milliseconds of a BIGINT or text column."""
    return F.expr(_millis_sql(name))


def event_time(name: str) -> Column:
    """UTC wall-clock time of a millisecond column, truncated to the second."""
    return F.expr(f"timestampadd(SECOND, ({_millis_sql(name)}) div 1000, {_EPOCH})")


def event_instant(name: str) -> Column:
    """Instant of a millisecond column at full precision, as watermarks need it."""
    return F.timestamp_millis(millis(name))


def utc(instant: Column) -> Column:
    """UTC wall-clock time of an instant."""
    return F.timestamp_add("MILLISECOND", F.unix_millis(instant), F.expr(_EPOCH))


def millis_of(wall_clock: str) -> Column:
    """Epoch milliseconds of a UTC TIMESTAMP_NTZ column."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), F.col(wall_clock))


def hour_start(name: str) -> Column:
    """Start of the UTC hour of a millisecond column."""
    return F.expr(f"timestampadd(HOUR, ({_millis_sql(name)}) div 3600000, {_EPOCH})")


def latency_seconds(ingested_ms: str, event_ms: str) -> Column:
    """Seconds from the event to its ingestion."""
    return (millis(ingested_ms) - millis(event_ms)) / F.lit(1000.0)
