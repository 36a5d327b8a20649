"""Gold tables of the speed layer, kept by Structured Streaming.

Most are *sums*: a micro-batch adds counts and sketches of its own events, without state or watermark,
and readers merge them. Late events correct the groups they fall into, whenever they come. Journeys
are a log of events by day beside counts by key and hour, so that numbers follow from the counts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import events as ev
from tidemark.operators import windows
from tidemark.operators.skew import same_keys
from tidemark.sinks import batches
from tidemark.sinks.batches import Write
from tidemark.sinks.tables import read_table, stream_table

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
DAY, HOUR = "journey_day", "journey_hour"
WINDOW_DATE, EVENT_DATE = "window_date", "window_event_date"


@dataclass(frozen=True)
class Sums:
    """A gold table whose rows add up: ``parts`` of events, merged by ``keys``, read as ``result``."""

    parts: Callable[[DataFrame], DataFrame]
    keys: Sequence[str]
    merged: Callable[[], Sequence[Column]]
    result: Callable[[DataFrame], DataFrame] = lambda rows: rows
    partition_by: Sequence[str] = ()

    def merge(self, parts: DataFrame) -> DataFrame:
        return parts.groupBy(*self.keys).agg(*self.merged())

    def write(self, path: str) -> Write:
        return batches.to_sums(path, self.parts, self.merge, self.partition_by)

    def read(
        self,
        spark: SparkSession,
        path: str,
        events: T.StructType | None = None,
        where: Column | None = None,
    ) -> DataFrame:
        """The merged table; with the schema of its ``events`` it may not yet be written.

        ``where`` is a condition on ``keys``; one on ``partition_by`` leaves the rest unread.
        """
        schema = None if events is None else self.parts(spark.createDataFrame([], events)).schema
        return self.result(batches.read_sums(spark, path, self.merge, schema, where))


def _sum(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def _windowed(
    measure: Callable[[DataFrame], DataFrame],
    key: str,
    merged: Callable[[], Sequence[Column]],
    result: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> Sums:
    """Sums of windows, stored by the day of the window."""
    return Sums(
        lambda events: measure(events).withColumn(WINDOW_DATE, windows.window_date()),
        ["window_start", "window_end", WINDOW_DATE, key],
        merged,
        lambda rows: result(rows.drop(WINDOW_DATE)),
        [WINDOW_DATE],
    )


PROFILES = Sums(
    ev.profile_parts,
    ["visitorid"],
    lambda: [
        *_sum("total_viewcount", "total_addtocart"),
        F.max("bought_something").alias("bought_something"),
        F.hll_union_agg("viewed_items").alias("viewed_items"),
    ],
    ev.profiles_of_parts,
)
BASKETS = Sums(
    lambda events: ev.basket_items(ev.purchases(events)),
    ["transactionid", "itemid"],
    lambda: _sum("copies"),
)
METRICS = _windowed(
    lambda events: windows.event_metrics(events, watermark=None),
    "event",
    lambda: _sum("event_count"),
)
BEHAVIOR = _windowed(
    windows.behavior_parts,
    "visitorid",
    lambda: [
        *_sum("total_events", "views", "addtocarts", "transactions"),
        F.hll_union_agg("seen_items").alias("seen_items"),
    ],
    windows.behavior_of_parts,
)
POPULARITY = _windowed(
    lambda events: windows.item_popularity(events, watermark=None),
    "itemid",
    lambda: _sum("interactions", "purchases"),
)
_COUNTS = Sums(
    lambda timed: timed.groupBy(*ev.JOURNEY_KEYS, HOUR).agg(F.count("*").alias("events")),
    [*ev.JOURNEY_KEYS, HOUR],
    lambda: _sum("events"),
)


def stream_sums(
    events: DataFrame, table: Sums, target: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    return batches.feed(events, checkpoint, [table.write(target)], wait=wait)


def stream_visitor_profile(
    events: DataFrame, target: str, checkpoint: str, complete: bool = False, wait: bool = True
) -> StreamingQuery:
    """Visitor profiles with approximate distinct items; read with ``read_profiles``.

    ``complete`` keeps all visitors in state and rewrites them per micro-batch, to be read with
    ``read_newest``.
    """
    if complete:
        profiles = ev.visitor_profile(events, approximate=True)
        return batches.replace_stream(profiles, target, checkpoint, wait=wait)
    return stream_sums(events, PROFILES, target, checkpoint, wait)


def read_profiles(spark: SparkSession, target: str) -> DataFrame:
    return PROFILES.read(spark, target)


def stream_item_cooccurrence(
    events: DataFrame, target: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Adds each micro-batch's items per transaction; read with ``read_baskets``."""
    return stream_sums(events, BASKETS, target, checkpoint, wait)


def read_basket_items(spark: SparkSession, target: str) -> DataFrame:
    return BASKETS.read(spark, target)


def read_baskets(spark: SparkSession, target: str) -> DataFrame:
    return ev.baskets(read_basket_items(spark, target))


def stored_window_end(spark: SparkSession, target: str) -> Column:
    """The end of the last stored window, a scalar subquery over the windows of the last day."""
    rows = batches.read_batches(spark, target)
    last_day = rows.agg(F.max(WINDOW_DATE)).scalar()
    return rows.filter(F.col(WINDOW_DATE) == last_day).agg(F.max("window_end")).scalar()


def read_recent_volume(
    spark: SparkSession,
    target: str,
    as_of: Column | None = None,
    events: T.StructType | None = None,
) -> DataFrame:
    """``recent_event_volume`` of the stored metrics, from the days of that hour alone."""
    earliest = windows.hour_before(as_of) - F.expr(f"INTERVAL {windows.METRICS_WIDTH}")
    metrics = METRICS.read(spark, target, events, F.col(WINDOW_DATE) >= F.to_date(earliest))
    return windows.recent_event_volume(metrics, as_of)


# --- windows computed anew where events came


def windows_write(
    events: Callable[[], DataFrame],
    target: str,
    measure: Callable[[DataFrame], DataFrame],
    width: str,
) -> Write:
    """Computes the windows that a micro-batch touches anew from all ``events``, and replaces them.

    ``events`` is the stored table behind the stream, with ``EVENT_DATE`` as its partition column:
    only the days touched are read, of events and of stored windows, and only these are rewritten.
    So the table equals the batch result however late events come, without state or watermark, and
    also for measures that do not add up, such as exact distinct counts. A replay computes the same
    windows again. Two such streams must not write to one table.
    """

    def write(batch: DataFrame, stream: str, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = windows.touched_windows(batch, width).persist()
        try:
            days = [day for (day,) in touched.select(windows.window_date()).distinct().collect()]
            if not days:
                return
            dated = events().filter(F.col(EVENT_DATE).isin(days)).drop(EVENT_DATE)
            started = windows.with_window_start(dated, width)
            again = started.join(touched, "window_start", "left_semi").drop("window_start")
            new = measure(again).withColumn(WINDOW_DATE, windows.window_date())
            old = batches.read_or_empty(spark, target, new.schema)
            old = old.filter(F.col(WINDOW_DATE).isin(days)).join(touched, "window_start", "left_anti")
            both = new.unionByName(old).hint("rebalance", F.col(WINDOW_DATE))
            batches.overwrite_partitions(both, target, [WINDOW_DATE])
        finally:
            touched.unpersist()

    return write


def stream_exact_windows(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    measure: Callable[[DataFrame], DataFrame],
    width: str,
    schema: T.StructType | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Keeps exact windows of a stored event log, partitioned by ``EVENT_DATE``."""
    rows = stream_table(spark, source, schema=schema)
    write = windows_write(lambda: read_table(spark, source, schema=schema), target, measure, width)
    return batches.feed(rows.drop(EVENT_DATE), checkpoint, [write], wait=wait)


def dated(events: DataFrame) -> DataFrame:
    """Events with the day their windows lie in, to be stored by it."""
    return events.withColumn(EVENT_DATE, windows.event_date())


def read_windows(spark: SparkSession, target: str) -> DataFrame:
    return read_table(spark, target).drop(WINDOW_DATE)


# --- journeys


def _timed(events: DataFrame) -> DataFrame:
    """Events with the number and the day of their hour; those without a valid time come first."""
    timed, _ = ev.with_position(events)
    hour = F.expr(f"(_at - pmod(_at, {HOUR_MS})) div {HOUR_MS}")
    day = F.date_from_unix_date(F.expr(f"(_at - pmod(_at, {DAY_MS})) div {DAY_MS}").cast("int"))
    return timed.withColumns({HOUR: hour, DAY: day}).drop("_at")


def journey_write(target: str) -> Write:
    """Appends events to the log by day, and adds their counts by key and hour."""
    log = batches.to_batches(f"{target}/log", partition_by=[DAY])
    counts = _COUNTS.write(f"{target}/counts")

    def write(batch: DataFrame, stream: str, batch_id: int) -> None:
        timed = _timed(batch)
        log(timed, stream, batch_id)
        counts(timed, stream, batch_id)

    return write


def stream_customer_journey(
    events: DataFrame, target: str, checkpoint: str, wait: bool = True
) -> StreamingQuery:
    """Keeps the log of journeys and its counts; read with ``read_journeys``."""
    return batches.feed(events, checkpoint, [journey_write(target)], wait=wait)


def _days(name: str, since: dt.date | None, until: dt.date | None) -> Column:
    asked = F.lit(True)
    if since is not None:
        asked = asked & (F.col(name) >= F.lit(since))
    if until is not None:
        asked = asked & (F.col(name) <= F.lit(until))
    return asked


def read_journeys(
    spark: SparkSession,
    target: str,
    since: dt.date | None = None,
    until: dt.date | None = None,
    visitors: Sequence[str] | None = None,
    events: T.StructType | None = None,
) -> DataFrame:
    """Events numbered in time order within each visitor and item, of the days asked for.

    Within a key's hour events are ranked; the key's counts of earlier hours are added. So only the
    days asked for are read and ranked, and a late event shifts later numbers through the counts
    alone. A task ranks one hour of one key at a time.
    """
    schema = None if events is None else _timed(spark.createDataFrame([], events)).schema
    log = batches.read_batches(spark, f"{target}/log", schema).drop(batches.STREAM, batches.BATCH)
    counts = _COUNTS.read(spark, f"{target}/counts", schema)
    if visitors is not None:
        log, counts = (t.filter(F.col("visitorid").isin(*visitors)) for t in (log, counts))
    log = log.filter(_days(DAY, since, until))
    keys = [*ev.JOURNEY_KEYS, HOUR]
    until_here = Window.partitionBy(*ev.JOURNEY_KEYS).orderBy(HOUR)
    earlier = until_here.rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *[F.col(key).alias(f"_of_{key}") for key in keys],
        F.coalesce(F.sum("events").over(earlier), F.lit(0)).alias("_before"),
    )
    timed, position = ev.with_position(log)
    rank = F.row_number().over(
        Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in position])
    )
    ranked = timed.withColumn("_rank", rank).join(
        before, same_keys(keys, [f"_of_{key}" for key in keys])
    )
    columns = [c for c in log.columns if c not in (DAY, HOUR)]
    return ranked.select(*columns, (F.col("_rank") + F.col("_before")).alias("event_order"))
