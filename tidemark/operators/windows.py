"""Tumbling event-time windows, on batch and streaming frames.

With a watermark, the default, a stream keeps bounded state and drops later rows; the batch run of the same
function is the correction. Window bounds are UTC wall-clock columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock

# The documented window widths.
METRICS_WIDTH = "5 minutes"
BEHAVIOR_WIDTH = "10 minutes"
POPULARITY_WIDTH = "15 minutes"
# How late a row of a stream may be; None keeps all windows open and their state for ever.
WATERMARK = "10 minutes"


def _per_window(
    events: DataFrame, width: str, key: str, measures: list[Column], watermark: str | None
) -> DataFrame:
    timed = events.withColumn("_at", clock.event_instant("timestamp"))
    if watermark is not None:
        timed = timed.withWatermark("_at", watermark)
    grouped = timed.groupBy(F.window("_at", width).alias("_window"), key).agg(*measures)
    bounds = [
        clock.utc(F.col("_window.start")).alias("window_start"),
        clock.utc(F.col("_window.end")).alias("window_end"),
    ]
    return grouped.select(*bounds, *[c for c in grouped.columns if c != "_window"])


def event_metrics(events: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """Events per type in 5-minute windows."""
    return _per_window(
        events, METRICS_WIDTH, "event", [F.count("*").alias("event_count")], watermark
    )


def visitor_behavior(
    events: DataFrame, watermark: str | None = WATERMARK, approximate: bool = False
) -> DataFrame:
    """What each visitor did in 10-minute windows."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [*_behavior_counts(), distinct("itemid").alias("unique_items")]
    return _per_window(events, BEHAVIOR_WIDTH, "visitorid", measures, watermark)


def _behavior_counts() -> list[Column]:
    return [
        F.count("*").alias("total_events"),
        F.count_if(F.col("event") == "view").alias("views"),
        F.count_if(F.col("event") == "addtocart").alias("addtocarts"),
        F.count_if(F.col("event") == "transaction").alias("transactions"),
    ]


def behavior_parts(events: DataFrame) -> DataFrame:
    """Behaviour in some events that merges with that in others, with a sketch of the items."""
    measures = [*_behavior_counts(), F.hll_sketch_agg("itemid").alias("seen_items")]
    return _per_window(events, BEHAVIOR_WIDTH, "visitorid", measures, None)


def behavior_of_parts(parts: DataFrame) -> DataFrame:
    estimate = F.hll_sketch_estimate("seen_items").alias("unique_items")
    return parts.select(*[c for c in parts.columns if c != "seen_items"], estimate)


def item_popularity(
    events: DataFrame, watermark: str | None = WATERMARK, purchase: str = "transaction"
) -> DataFrame:
    """Interactions with and purchases of each item in 15-minute windows."""
    measures = [
        F.count("*").alias("interactions"),
        F.count_if(F.col("event") == purchase).alias("purchases"),
    ]
    return _per_window(events, POPULARITY_WIDTH, "itemid", measures, watermark)


def trending_items(popularity: DataFrame, n: int = 20) -> DataFrame:
    return popularity.orderBy(F.desc("interactions"), "window_start", "itemid").limit(n)


def hour_before(as_of: Column | None = None) -> Column:
    """An hour before ``as_of`` (default: now), as UTC wall-clock time."""
    now = clock.utc(F.current_timestamp()) if as_of is None else as_of
    return now - F.expr("INTERVAL 1 HOUR")


def recent_events(
    events: DataFrame, as_of: Column | None = None, width: str = METRICS_WIDTH
) -> DataFrame:
    """Events that may lie in a window that ended within the hour before ``as_of``.

    Taken before grouping, so that older events are neither shuffled nor, where they are stored in
    time order, read. The earliest window left may be incomplete; it ended before that hour.
    """
    return events.filter(F.col("event_time") > hour_before(as_of) - F.expr(f"INTERVAL {width}"))


def recent_event_volume(metrics: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Windows and events per type that ended within the hour before ``as_of`` (default: now)."""
    return (
        metrics.filter(F.col("window_end") > hour_before(as_of))
        .groupBy("event")
        .agg(F.count("*").alias("windows"), F.sum("event_count").alias("event_count"))
    )


def last_window_end(events: DataFrame, width: str = METRICS_WIDTH) -> Column:
    """The end of the latest event's window, a scalar subquery: one maximum, no grouped rows."""
    latest = events.agg(F.max(clock.millis("timestamp")).alias("_last"))
    window = F.window(F.timestamp_millis("_last"), width).getField("end")
    return latest.select(clock.utc(window).alias("window_end")).scalar()


def window_date() -> Column:
    """The UTC day a window lies in; all widths divide a day."""
    return F.to_date("window_start")


def event_date() -> Column:
    """The UTC day an event's windows lie in, at full precision."""
    return F.to_date(clock.utc(clock.event_instant("timestamp")))


def touched_windows(events: DataFrame, width: str) -> DataFrame:
    """``window_start`` of the windows that have an event here."""
    return with_window_start(events, width).select("window_start").distinct()


def with_window_start(events: DataFrame, width: str) -> DataFrame:
    """Events with the start of their window; those without a valid time lie in none."""
    start = F.window(clock.event_instant("timestamp"), width).getField("start")
    started = events.select("*", start.alias("_start"))
    return started.withColumn("window_start", clock.utc(F.col("_start"))).drop("_start")
