"""Every operator as a query over the given tables.

Lists are rendered as comma-joined text and wall-clock load times are left out, so that a result
can be compared with another engine's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock, validation
from tidemark.operators import events as ev
from tidemark.operators import properties as props
from tidemark.operators import distinct, quality, windows
from tidemark.plans import batch_layer, fixtures, speed_layer
from tidemark.schemas import (
    DOCUMENTED_EVENT_TYPES,
    EVENT_CSV,
    EVENT_MESSAGE,
    EVENT_TYPES,
    PROPERTY_CSV,
)
from tidemark.session import workspace
from tidemark.sinks import batches
from tidemark.sinks.tables import append_stream, read_table, write_table
from tidemark.sources import messages
from tidemark.sources.files import read_csv, stream_csv
from tidemark.streaming import gold

Query = Callable[[SparkSession, str], DataFrame]

EVENT_COLUMNS = EVENT_CSV.fieldNames()
LOOKUP_VISITOR = "7"
LOOKUP_ITEM = "53"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _text(name: str):
    return F.array_join(F.col(name).cast("array<string>"), ",").alias(name)


def _with_text(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: _text(name) for name in names})


# --- item properties -------------------------------------------------------------------------


@query
def bronze_item_properties(spark, sf_dir):
    home = workspace(spark, "bronze_item_properties")
    landing = fixtures.land_item_properties(spark, sf_dir, f"{home}/landing")
    batch_layer.ingest(spark, landing, f"{home}/bronze", f"{home}/checkpoint")
    return read_table(spark, f"{home}/bronze").select(*PROPERTY_CSV.fieldNames())


@query
def csv_inferred_preview(spark, sf_dir):
    home = workspace(spark, "csv_inferred_preview")
    return read_csv(spark, fixtures.land_item_properties(spark, sf_dir, f"{home}/landing"))


@query
def bronze_preview(spark, sf_dir):
    bronze = fixtures.bronze_item_properties(spark, sf_dir).select(*PROPERTY_CSV.fieldNames())
    return quality.preview(bronze, PROPERTY_CSV.fieldNames())


@query
def bronze_completeness(spark, sf_dir):
    return quality.completeness(fixtures.bronze_item_properties(spark, sf_dir))


@query
def bronze_completeness_stored(spark, sf_dir):
    """The same from the footers of a stored table, without reading a row."""
    target = f"{workspace(spark, 'bronze_completeness_stored')}/bronze"
    write_table(fixtures.bronze_item_properties(spark, sf_dir), target)
    return quality.stored_completeness(spark, target)


@query
def dedup_ratio(spark, sf_dir):
    return quality.dedup_ratio(fixtures.bronze_item_properties(spark, sf_dir))


@query
def schema_evolution_append(spark, sf_dir):
    """An append that adds a column to a table; older rows have NULL there."""
    target = f"{workspace(spark, 'schema_evolution_append')}/bronze"
    rows = fixtures.as_item_properties(fixtures.table(spark, sf_dir, "lineitem"))
    write_table(rows, target, mode="append")
    write_table(rows.withColumn("_load_id", F.lit("second")), target, mode="append")
    return read_table(spark, target, merge_schema=True)


@query
def schema_evolution_catalog(spark, sf_dir):
    """The same on a catalog table, which itself gets the column."""
    target = f"evolved_{uuid.uuid4().hex}"
    rows = fixtures.as_item_properties(fixtures.table(spark, sf_dir, "lineitem"))
    write_table(rows, target)
    write_table(rows.withColumn("_load_id", F.lit("second")), target, mode="append")
    return read_table(spark, target)


@query
def schema_evolution_stream(spark, sf_dir):
    """A stream whose second drop has one more column; the catalog table gets it before the restart."""
    home = workspace(spark, "schema_evolution_stream")
    target = f"evolved_{uuid.uuid4().hex}"
    rows = fixtures.as_item_properties(fixtures.table(spark, sf_dir, "lineitem"))
    for drop in (rows, rows.withColumn("_load_id", F.lit("second")), rows.limit(0)):
        drop.write.mode("append").parquet(f"{home}/landing")
        landed = spark.readStream.schema(drop.schema).parquet(f"{home}/landing")
        append_stream(landed, target, f"{home}/checkpoint")
    return read_table(spark, target)


@query
def csv_inferred_stream(spark, sf_dir):
    """Files read as a stream with the types inferred from them."""
    home = workspace(spark, "csv_inferred_stream")
    landing = fixtures.land_item_properties(spark, sf_dir, f"{home}/landing")
    append_stream(stream_csv(spark, landing), f"{home}/bronze", f"{home}/checkpoint")
    return read_table(spark, f"{home}/bronze")


@query
def silver_documented_required(spark, sf_dir):
    """Silver by the documented rule: time and item must be present, the property may be missing."""
    bronze = fixtures.bronze_item_properties(spark, sf_dir).withColumns(
        {
            "timestamp": F.when(F.col("itemid") % 5 != 0, F.col("timestamp")),
            "property": F.when(F.col("property") % 3 != 0, F.col("property")),
        }
    )
    silver = props.silver_item_properties(bronze, required=("timestamp_unix", "item_id"))
    return silver.drop("ingestion_timestamp", "source_file")


@query
def silver_incremental(spark, sf_dir):
    """Silver merged drop by drop; each drop rewrites only the buckets of its items."""
    home = workspace(spark, "silver_incremental")
    rows = fixtures.as_item_properties(fixtures.table(spark, sf_dir, "lineitem"))
    second = F.coalesce(F.col("timestamp"), F.lit(0)) % (2 * 86_400_000) >= 86_400_000
    for drop in (rows.filter(~second), rows.filter(second)):
        drop.write.mode("append").option("header", True).csv(f"{home}/landing")
        batch_layer.ingest(spark, f"{home}/landing", f"{home}/bronze", f"{home}/checkpoint")
        batch_layer.refine_new(
            spark, f"{home}/bronze", f"{home}/silver", f"{home}/checkpoint-silver", buckets=8
        )
    silver = read_table(spark, f"{home}/silver")
    return silver.drop("ingestion_timestamp", "source_file", batch_layer.BUCKET)


@query
def silver_item_properties(spark, sf_dir):
    silver = fixtures.silver_item_properties(spark, sf_dir)
    return silver.drop("ingestion_timestamp", "source_file")


@query
def silver_partitioned_table(spark, sf_dir):
    """Silver stored by year and month, rebuilt over its own earlier version."""
    path = f"{workspace(spark, 'silver_partitioned_table')}/silver"
    for _ in range(2):
        silver = fixtures.silver_item_properties(spark, sf_dir)
        write_table(silver, path, partition_by=("event_year", "event_month"))
    return read_table(spark, path).drop("ingestion_timestamp", "source_file")


@query
def silver_quality(spark, sf_dir):
    return quality.silver_quality(fixtures.silver_item_properties(spark, sf_dir))


@query
def silver_null_check(spark, sf_dir):
    return quality.null_key_check(fixtures.silver_item_properties(spark, sf_dir))


@query
def item_property_summary(spark, sf_dir):
    summary = props.item_property_summary(fixtures.silver_item_properties(spark, sf_dir))
    return _with_text(summary.drop("computed_at"), "property_ids")


@query
def top_enriched_items(spark, sf_dir):
    top = props.top_enriched_items(fixtures.silver_item_properties(spark, sf_dir))
    return _with_text(top.drop("computed_at"), "property_ids")


@query
def property_statistics(spark, sf_dir):
    silver = fixtures.silver_item_properties(spark, sf_dir)
    return props.property_statistics(silver).drop("computed_at")


@query
def top_properties(spark, sf_dir):
    silver = fixtures.silver_item_properties(spark, sf_dir)
    return props.top_properties(props.property_statistics(silver)).drop("computed_at")


@query
def item_property_lists(spark, sf_dir):
    lists = props.item_property_lists(fixtures.silver_item_properties(spark, sf_dir))
    return _with_text(lists, "property_ids", "property_values")


@query
def property_count_per_item(spark, sf_dir):
    return props.property_count_per_item(fixtures.silver_item_properties(spark, sf_dir))


@query
def gold_lineage(spark, sf_dir):
    """Counts of the stored gold tables."""
    home = workspace(spark, "gold_lineage")
    write_table(fixtures.silver_item_properties(spark, sf_dir), f"{home}/silver")
    batch_layer.aggregate(spark, f"{home}/silver", f"{home}/summary", f"{home}/statistics")
    tables = [
        ("item_property_summary", read_table(spark, f"{home}/summary"), "item_id"),
        ("property_statistics", read_table(spark, f"{home}/statistics"), "property_id"),
    ]
    return quality.gold_lineage(tables).drop("last_refresh")


@query
def batch_layer_gold(spark, sf_dir):
    """The whole batch layer from CSV files; the item summary as written.

    Silver is partitioned by month: the test table has a handful of rows per day.
    """
    home = workspace(spark, "batch_layer")
    landing = fixtures.land_item_properties(spark, sf_dir, f"{home}/landing")
    tables = [f"{home}/{name}" for name in ("bronze", "silver", "summary", "statistics")]
    months = ("event_year", "event_month")
    batch_layer.run(spark, landing, f"{home}/checkpoint", *tables, partition_by=months)
    return _with_text(read_table(spark, tables[2]).drop("computed_at"), "property_ids")


# --- events: messages, bronze and silver -----------------------------------------------------


@query
def publish_events(spark, sf_dir):
    """CSV files published as keyed JSON; the messages read back, field by field."""
    home = workspace(spark, "publish_events")
    landing = fixtures.land_events(spark, sf_dir, f"{home}/landing")
    speed_layer.publish(spark, landing, home)
    payload = F.from_json(F.col("data").cast("string"), EVENT_MESSAGE).alias("sent")
    sent = read_table(spark, f"{home}/messages").select("*", payload)
    return sent.select(
        F.col("partitionKey").alias("key"),
        *[F.col(f"sent.{name}").alias(name) for name in EVENT_COLUMNS],
        F.col("sent._ingestion_id").isNotNull().alias("has_ingestion_id"),
        F.col("sent._ingestion_timestamp").isNotNull().alias("has_ingestion_time"),
        F.col("sent._source_file").isNotNull().alias("has_source_file"),
        "validation_status",
    )


@query
def publish_counts(spark, sf_dir):
    """Messages sent and rejected by a load in which every tenth visitor is missing."""
    home = workspace(spark, "publish_counts")
    rows = fixtures.event_files(fixtures.table_stream(spark, sf_dir, "events"))
    missing = F.col("_ingestion_id").cast("bigint") % 10 == 0
    rows = rows.withColumn("visitorid", F.when(~missing, F.col("visitorid")))
    counts = messages.LoadCounts()
    query_ = messages.publish_events(rows, f"{home}/messages", f"{home}/checkpoint", counts=counts)
    sent = counts.totals(query_)
    # One row of counts, which the pass that published the rows has reported.
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in sent.items()])


@query
def publish_rejected(spark, sf_dir):
    """The same load's rejected rows, as text with the reason."""
    home = workspace(spark, "publish_rejected")
    rows = fixtures.event_files(fixtures.table_stream(spark, sf_dir, "events"))
    missing = F.col("_ingestion_id").cast("bigint") % 10 == 0
    rows = rows.withColumn("visitorid", F.when(~missing, F.col("visitorid")))
    messages.publish_events(rows, f"{home}/messages", f"{home}/checkpoint")
    rejected = messages.rejected_messages(spark, f"{home}/messages")
    return rejected.select(
        *[F.get_json_object("row", f"$.{name}").alias(name) for name in EVENT_COLUMNS],
        "validation_error",
    )


@query
def malformed_payloads(spark, sf_dir):
    """Published messages of which every eighth is cut off: silver and quarantine, from one pass."""
    home = workspace(spark, "malformed_payloads")
    rows = fixtures.event_files(fixtures.table_stream(spark, sf_dir, "events"))
    messages.publish_events(rows, f"{home}/whole", f"{home}/checkpoints/whole")
    whole = read_table(spark, f"{home}/whole")
    item = F.get_json_object(F.col("data").cast("string"), "$.itemid").cast("int")
    cut = F.expr("CAST(left(CAST(data AS STRING), length(CAST(data AS STRING)) - 7) AS BINARY)")
    broken = whole.withColumn("data", F.when(item % 8 == 0, cut).otherwise(F.col("data")))
    broken.write.partitionBy("validation_status").parquet(f"{home}/messages")
    speed_layer.to_bronze(spark, home)
    speed_layer.to_silver(spark, home)
    parts = {
        "published": whole,
        "malformed": speed_layer.malformed_payloads(spark, home),
        "silver": read_table(spark, f"{home}/silver"),
    }
    return reduce(
        DataFrame.union,
        [
            rows.agg(F.lit(name).alias("part"), F.count("*").alias("record_count"))
            for name, rows in parts.items()
        ],
    )


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.event_files(fixtures.table(spark, sf_dir, "events"))
    return messages.in_envelope(messages.to_messages(messages.event_records(rows)))


@query
def bronze_events(spark, sf_dir):
    return ev.bronze_events(_messages(spark, sf_dir)).select(*EVENT_COLUMNS)


@query
def bronze_processing_time(spark, sf_dir):
    """Bronze events are stamped when they are processed, not before they arrived."""
    bronze = ev.bronze_events(_messages(spark, sf_dir))
    stamped = F.col("_processing_time") >= F.col("kinesis_timestamp")
    return bronze.select(*EVENT_COLUMNS, stamped.alias("stamped"))


@query
def events_renamed(spark, sf_dir):
    return ev.events_renamed(ev.bronze_events(_messages(spark, sf_dir))).drop("kinesis_time")


@query
def silver_events(spark, sf_dir):
    return fixtures.silver_events(spark, sf_dir).select(*EVENT_COLUMNS, "event_time")


@query
def silver_events_validated(spark, sf_dir):
    return ev.silver_events_validated(fixtures.bronze_events(spark, sf_dir))


@query
def silver_events_documented(spark, sf_dir):
    """The documented vocabulary, in mixed case, over the raw event names."""
    bronze = fixtures.table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("_ingestion_id"),
        clock.millis_of("ts").cast("string").alias("timestamp"),
        F.when(F.col("user_id") % 7 != 0, F.col("user_id").cast("string")).alias("visitorid"),
        F.when(F.col("event_id") % 2 == 0, F.upper("event_type"))
        .when(F.col("event_id") % 3 == 0, F.initcap("event_type"))
        .otherwise(F.col("event_type"))
        .alias("event"),
    )
    return ev.silver_events_validated(bronze, DOCUMENTED_EVENT_TYPES, any_case=True)


@query
def events_date_parts(spark, sf_dir):
    time = F.col("event_time")
    return (
        fixtures.bronze_events(spark, sf_dir)
        .select("_ingestion_id", clock.event_time("timestamp").alias("event_time"))
        .select(
            "*",
            F.to_date(time).alias("event_date"),
            F.year(time).alias("event_year"),
            F.month(time).alias("event_month"),
            F.hour(time).alias("event_hour"),
        )
    )


@query
def ingestion_latency(spark, sf_dir):
    return ev.with_latency(fixtures.bronze_events(spark, sf_dir)).select(
        "event_timestamp",
        "visitorid",
        "event",
        "item_id",
        "event_date",
        "ingestion_latency_seconds",
    )


@query
def events_appended_by_date(spark, sf_dir):
    """The exploratory silver table: appended, partitioned by date."""
    path = f"{workspace(spark, 'events_appended_by_date')}/silver"
    rows = ev.with_latency(fixtures.bronze_events(spark, sf_dir))
    write_table(rows, path, mode="append", partition_by=["event_date"])
    return read_table(spark, path).select(*EVENT_COLUMNS, "event_date")


@query
def events_batch_callback(spark, sf_dir):
    """A stream appended by a callback that enriches each micro-batch."""
    home = workspace(spark, "events_batch_callback")
    enrich = batches.to_batches(
        f"{home}/bronze", lambda batch: batch.withColumn("_ingestion_time", F.current_timestamp())
    )
    batches.feed(fixtures.bronze_events_stream(spark, sf_dir), f"{home}/checkpoint", [enrich])
    stored = batches.read_batches(spark, f"{home}/bronze")
    return stored.select(*EVENT_COLUMNS, F.col("_ingestion_time").isNotNull().alias("enriched"))


def _checked_events(spark, sf_dir):
    return validation.with_status(
        fixtures.bronze_events(spark, sf_dir), validation.event_error(EVENT_TYPES)
    )


@query
def events_validation_report(spark, sf_dir):
    return quality.validation_report(_checked_events(spark, sf_dir))


@query
def events_quarantine(spark, sf_dir):
    rejected = validation.failed(_checked_events(spark, sf_dir))
    return rejected.select(*EVENT_COLUMNS, "validation_status", "validation_error")


@query
def validation_error_count(spark, sf_dir):
    return quality.validation_error_count(_checked_events(spark, sf_dir))


@query
def events_overview(spark, sf_dir):
    return quality.events_overview(fixtures.bronze_events(spark, sf_dir))


@query
def events_overview_by_load(spark, sf_dir):
    """The overview from bitmaps of three loads, the second of which comes twice."""
    target = f"{workspace(spark, 'events_overview_by_load')}/bitmaps"
    bronze = fixtures.bronze_events(spark, sf_dir)
    for load in (0, 1, 1, 2):
        rows = bronze.filter(F.pmod(F.col("_ingestion_id").cast("bigint"), F.lit(3)) == load)
        distinct.add_load(rows, ["visitorid", "itemid"], target, f"load-{load}")
    names = {"visitorid": "unique_visitors", "itemid": "unique_items"}
    return distinct.distinct_counts(read_table(spark, target), names, total="total_events")


@query
def events_by_type(spark, sf_dir):
    return ev.events_by_type(fixtures.bronze_events(spark, sf_dir))


@query
def event_timeline(spark, sf_dir):
    return ev.event_timeline(fixtures.silver_events(spark, sf_dir))


@query
def top_visitors(spark, sf_dir):
    return ev.top_by_events(fixtures.silver_events(spark, sf_dir), "visitorid")


@query
def top_items(spark, sf_dir):
    return ev.top_by_events(fixtures.silver_events(spark, sf_dir), "itemid")


@query
def data_freshness(spark, sf_dir):
    return quality.data_freshness(fixtures.bronze_events(spark, sf_dir))


@query
def ingestion_rate_daily(spark, sf_dir):
    return quality.ingestion_rate_daily(fixtures.bronze_events(spark, sf_dir))


@query
def ingestion_rate_hourly(spark, sf_dir):
    return quality.ingestion_rate_hourly(fixtures.bronze_events(spark, sf_dir))


# --- events: gold ----------------------------------------------------------------------------


@query
def visitor_profile(spark, sf_dir):
    return ev.visitor_profile(fixtures.silver_events(spark, sf_dir))


@query
def top_viewers(spark, sf_dir):
    return ev.top_viewers(ev.visitor_profile(fixtures.silver_events(spark, sf_dir)))


@query
def customer_journey(spark, sf_dir):
    journey = ev.customer_journey(fixtures.silver_events(spark, sf_dir))
    return journey.select(*EVENT_COLUMNS, "event_time", "event_order")


@query
def visitor_journey_lookup(spark, sf_dir):
    journey = ev.visitor_journey(fixtures.silver_events(spark, sf_dir), LOOKUP_VISITOR)
    return journey.select(*EVENT_COLUMNS, "event_time", "event_order")


@query
def item_cooccurrence(spark, sf_dir):
    baskets = ev.item_cooccurrence(fixtures.silver_events(spark, sf_dir))
    return _with_text(baskets, "items_bought_together")


@query
def baskets_containing_item(spark, sf_dir):
    baskets = ev.baskets_with_item(fixtures.silver_events(spark, sf_dir), LOOKUP_ITEM)
    return _with_text(baskets, "items_bought_together")


@query
def event_metrics_5m(spark, sf_dir):
    return windows.event_metrics(fixtures.silver_events(spark, sf_dir))


@query
def visitor_behavior_10m(spark, sf_dir):
    return windows.visitor_behavior(fixtures.silver_events(spark, sf_dir))


@query
def item_popularity_15m(spark, sf_dir):
    return windows.item_popularity(fixtures.silver_events(spark, sf_dir))


@query
def trending_items(spark, sf_dir):
    return windows.trending_items(windows.item_popularity(fixtures.silver_events(spark, sf_dir)))


@query
def recent_event_volume(spark, sf_dir):
    """The last hour of the data, up to the end of its latest window."""
    events = fixtures.silver_events(spark, sf_dir)
    as_of = windows.last_window_end(events)
    metrics = windows.event_metrics(windows.recent_events(events, as_of))
    return windows.recent_event_volume(metrics, as_of)


# --- events: streams -------------------------------------------------------------------------


@query
def bronze_events_stream(spark, sf_dir):
    """Events published as messages and parsed into bronze, both as streams."""
    home = workspace(spark, "bronze_events_stream")
    rows = fixtures.event_files(fixtures.table_stream(spark, sf_dir, "events"))
    messages.publish_events(rows, f"{home}/messages", f"{home}/checkpoints/messages")
    speed_layer.to_bronze(spark, home)
    return read_table(spark, f"{home}/bronze").select(*EVENT_COLUMNS)


@query
def silver_events_stream(spark, sf_dir):
    home = workspace(spark, "silver_events_stream")
    append_stream(
        fixtures.bronze_events_stream(spark, sf_dir), f"{home}/bronze", f"{home}/checkpoints/bronze"
    )
    speed_layer.to_silver(spark, home)
    return read_table(spark, f"{home}/silver").select(*EVENT_COLUMNS, "event_time")


@query
def silver_events_restarted(spark, sf_dir):
    """Two drops with a restart after each, and one more restart without a drop."""
    home = workspace(spark, "silver_events_restarted")
    rows = fixtures.bronze_events(spark, sf_dir)
    late = F.crc32("_ingestion_id") % 2 == 1
    for drop in (rows.filter(~late), rows.filter(late), rows.limit(0)):
        drop.write.mode("append").parquet(f"{home}/landing")
        landed = spark.readStream.schema(rows.schema).parquet(f"{home}/landing")
        append_stream(ev.silver_events(landed), f"{home}/silver", f"{home}/checkpoint")
    return read_table(spark, f"{home}/silver").select(*EVENT_COLUMNS, "event_time")


@query
def visitor_profile_stream(spark, sf_dir):
    """The stream's exact columns, and whether its sketch is as close as its error allows."""
    home = workspace(spark, "visitor_profile_stream")
    events = fixtures.silver_events_stream(spark, sf_dir)
    gold.stream_visitor_profile(events, f"{home}/profiles", f"{home}/checkpoint")
    exact = ev.visitor_profile(fixtures.silver_events(spark, sf_dir)).select(
        F.col("visitorid").alias("_visitor"), F.col("unique_items_viewed").alias("_exact")
    )
    profiles = gold.read_profiles(spark, f"{home}/profiles")
    compared = profiles.join(exact, F.col("visitorid").eqNullSafe(F.col("_visitor")), "left")
    return compared.select(
        "visitorid",
        "total_viewcount",
        "total_addtocart",
        "bought_something",
        _close("unique_items_viewed").alias("unique_items_close"),
    )


def _close(sketched: str):
    """Within three standard errors of the sketch (0.05 each), or one item."""
    tolerance = F.greatest(F.lit(1.0), F.lit(0.15) * F.col("_exact"))
    return F.coalesce(F.abs(F.col(sketched) - F.col("_exact")) <= tolerance, F.lit(False))


@query
def customer_journey_stream(spark, sf_dir):
    home = workspace(spark, "customer_journey_stream")
    events = fixtures.silver_events_stream(spark, sf_dir)
    gold.stream_customer_journey(events, f"{home}/journey", f"{home}/checkpoint")
    journey = gold.read_journeys(spark, f"{home}/journey")
    return journey.select(*EVENT_COLUMNS, "event_time", "event_order")


@query
def item_cooccurrence_stream(spark, sf_dir):
    home = workspace(spark, "item_cooccurrence_stream")
    events = fixtures.silver_events_stream(spark, sf_dir)
    gold.stream_item_cooccurrence(events, f"{home}/baskets", f"{home}/checkpoint")
    return _with_text(gold.read_baskets(spark, f"{home}/baskets"), "items_bought_together")


@query
def event_metrics_5m_stream(spark, sf_dir):
    """Complete mode: each micro-batch writes all of the few groups anew."""
    home = workspace(spark, "event_metrics_5m_stream")
    metrics = windows.event_metrics(fixtures.silver_events_stream(spark, sf_dir), watermark=None)
    batches.replace_stream(metrics, f"{home}/metrics", f"{home}/checkpoint")
    return batches.read_newest(spark, f"{home}/metrics")


@query
def event_metrics_5m_watermark(spark, sf_dir):
    """Append mode: each window is written once, when the watermark has passed its end."""
    home = workspace(spark, "event_metrics_5m_watermark")
    events = fixtures.silver_events_stream(spark, sf_dir)
    append_stream(windows.event_metrics(events), f"{home}/metrics", f"{home}/checkpoint")
    return read_table(spark, f"{home}/metrics")


def _behavior_compared(spark, sf_dir, behavior):
    """The exact columns of a stream's behaviour, and whether its sketch is close enough."""
    exact = windows.visitor_behavior(fixtures.silver_events(spark, sf_dir)).select(
        F.col("window_start").alias("_start"),
        F.col("visitorid").alias("_visitor"),
        F.col("unique_items").alias("_exact"),
    )
    same = (F.col("window_start") == F.col("_start")) & F.col("visitorid").eqNullSafe(
        F.col("_visitor")
    )
    compared = behavior.join(exact, same, "left")
    return compared.withColumn("unique_items_close", _close("unique_items")).drop(
        "unique_items", "_start", "_visitor", "_exact"
    )


@query
def visitor_behavior_10m_watermark(spark, sf_dir):
    home = workspace(spark, "visitor_behavior_10m_watermark")
    events = fixtures.silver_events_stream(spark, sf_dir)
    behavior = windows.visitor_behavior(events, approximate=True)
    append_stream(behavior, f"{home}/behavior", f"{home}/checkpoint")
    return _behavior_compared(spark, sf_dir, read_table(spark, f"{home}/behavior"))


@query
def item_popularity_15m_watermark(spark, sf_dir):
    home = workspace(spark, "item_popularity_15m_watermark")
    popularity = windows.item_popularity(fixtures.silver_events_stream(spark, sf_dir))
    append_stream(popularity, f"{home}/popularity", f"{home}/checkpoint")
    return read_table(spark, f"{home}/popularity")


@query
def visitor_behavior_10m_stream(spark, sf_dir):
    """Update mode: each micro-batch writes the groups it changed, which state keeps."""
    home = workspace(spark, "visitor_behavior_10m_stream")
    events = fixtures.silver_events_stream(spark, sf_dir)
    behavior = windows.visitor_behavior(events, watermark=None, approximate=True)
    batches.update_stream(behavior, f"{home}/behavior", f"{home}/checkpoint")
    latest = batches.read_latest(spark, f"{home}/behavior", ["window_start", "visitorid"])
    return _behavior_compared(spark, sf_dir, latest)


@query
def item_popularity_15m_stream(spark, sf_dir):
    """Sums: each micro-batch adds the counts of its own events."""
    home = workspace(spark, "item_popularity_15m_stream")
    events = fixtures.silver_events_stream(spark, sf_dir)
    gold.stream_sums(events, gold.POPULARITY, f"{home}/popularity", f"{home}/checkpoint")
    return gold.POPULARITY.read(spark, f"{home}/popularity")


@query
def recent_event_volume_stored(spark, sf_dir):
    """The last hour of a stored metrics table, from the partitions of its days."""
    home = workspace(spark, "recent_event_volume_stored")
    events = fixtures.silver_events_stream(spark, sf_dir)
    gold.stream_sums(events, gold.METRICS, f"{home}/metrics", f"{home}/checkpoint")
    as_of = gold.stored_window_end(spark, f"{home}/metrics")
    return gold.read_recent_volume(spark, f"{home}/metrics", as_of)


def _corrected(spark, sf_dir, name, measure, width):
    """Windows kept exact over two drops, the second of events late by up to the whole history."""
    home = workspace(spark, name)
    events = gold.dated(fixtures.silver_events(spark, sf_dir))
    late = F.crc32("_ingestion_id") % 3 == 1
    for drop in (events.filter(~late), events.filter(late)):
        write_table(drop, f"{home}/silver", mode="append", partition_by=[gold.EVENT_DATE])
        gold.stream_exact_windows(
            spark, f"{home}/silver", f"{home}/gold", f"{home}/checkpoint", measure, width, events.schema
        )
    return gold.read_windows(spark, f"{home}/gold")


@query
def event_metrics_5m_corrected(spark, sf_dir):
    return _corrected(
        spark, sf_dir, "event_metrics_5m_corrected", windows.event_metrics, windows.METRICS_WIDTH
    )


@query
def visitor_behavior_10m_corrected(spark, sf_dir):
    return _corrected(
        spark, sf_dir, "visitor_behavior_10m_corrected", windows.visitor_behavior, windows.BEHAVIOR_WIDTH
    )


@query
def item_popularity_15m_corrected(spark, sf_dir):
    return _corrected(
        spark, sf_dir, "item_popularity_15m_corrected", windows.item_popularity, windows.POPULARITY_WIDTH
    )


@query
def speed_layer_gold(spark, sf_dir):
    """The whole speed layer from CSV files; rows, keys and a checksum per gold table."""
    home = workspace(spark, "speed_layer")
    landing = fixtures.land_events(spark, sf_dir, f"{home}/landing")
    tables = speed_layer.run(spark, landing, home)

    def checked(name, key, measure):
        return tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("record_count"),
            F.count_distinct(key).alias("unique_keys"),
            F.sum(measure).cast("bigint").alias("checksum"),
        )

    parts = [
        checked("visitor_profile", F.col("visitorid"), F.col("total_viewcount")),
        checked("customer_journey", F.struct(*ev.JOURNEY_KEYS), F.col("event_order")),
        checked("item_cooccurrence", F.col("transactionid"), F.size("items_bought_together")),
        checked("event_metrics", F.struct("window_start", "event"), F.col("event_count")),
        checked("visitor_behavior", F.struct("window_start", "visitorid"), F.col("total_events")),
        checked("item_popularity", F.struct("window_start", "itemid"), F.col("interactions")),
    ]
    return reduce(DataFrame.union, parts)
