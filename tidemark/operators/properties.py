"""Item properties: bronze metadata, the silver layer and its gold tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import clock


def with_ingestion_metadata(rows: DataFrame, load_id: str | None = None) -> DataFrame:
    """Adds load time, source file and load id to rows read from files."""
    return rows.select(
        "*",
        F.current_timestamp().alias("_ingestion_time"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(load_id or uuid.uuid4().hex).alias("_load_id"),
    )


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    Each input task keeps one row per key before the shuffle, so a hot key costs nothing extra.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


TYPED = (
    "timestamp_unix", "item_id", "property_id", "property_value", "ingestion_timestamp", "source_file",
)


def typed_item_properties(
    bronze: DataFrame, required: Sequence[str] = ("item_id", "property_id")
) -> DataFrame:
    """The columns ``TYPED`` of rows with the required ones present."""
    typed = bronze.select(
        F.col("timestamp").cast("bigint").alias("timestamp_unix"),
        F.col("itemid").cast("int").alias("item_id"),
        F.col("property").cast("int").alias("property_id"),
        F.col("value").cast("string").alias("property_value"),
        F.col("_ingestion_time").alias("ingestion_timestamp"),
        F.col("_source_file").alias("source_file"),
    )
    for name in required:
        typed = typed.filter(F.col(name).isNotNull())
    return typed


def silver_item_properties(
    bronze: DataFrame, required: Sequence[str] = ("item_id", "property_id")
) -> DataFrame:
    """Typed rows with the required columns present, latest per item and property."""
    return latest_item_properties(typed_item_properties(bronze, required))


def latest_item_properties(typed: DataFrame) -> DataFrame:
    """The latest of typed rows per item and property, which may themselves come from silver.

    Equal timestamps are settled by the later load, then by value and file. The time columns are
    derived after the deduplication, so they are neither shuffled nor computed for dropped rows.
    """
    newest = [
        F.col(name).desc_nulls_last()
        for name in ("timestamp_unix", "ingestion_timestamp", "property_value", "source_file")
    ]
    latest = latest_per_key(typed, ["item_id", "property_id"], newest)
    return latest.select(
        "timestamp_unix",
        clock.event_time("timestamp_unix").alias("event_time"),
        "item_id",
        "property_id",
        "property_value",
        "ingestion_timestamp",
        "source_file",
    ).withColumns(
        {
            "event_date": F.to_date("event_time"),
            "event_year": F.year("event_time"),
            "event_month": F.month("event_time"),
        }
    )


def item_property_summary(silver: DataFrame) -> DataFrame:
    """Per item: distinct properties and their list, rows, first and last time, days between."""
    summary = silver.groupBy("item_id").agg(
        F.sort_array(F.collect_set("property_id")).alias("property_ids"),
        F.count("*").alias("total_values"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )
    return summary.select(
        "item_id",
        F.size("property_ids").cast("bigint").alias("property_count"),
        "total_values",
        "property_ids",
        "first_seen",
        "last_seen",
        F.date_diff("last_seen", "first_seen").alias("days_active"),
        F.current_timestamp().alias("computed_at"),
    )


def top_enriched_items(silver: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` items with the most properties."""
    summary = item_property_summary(silver)
    return summary.orderBy(F.desc("property_count"), "item_id").limit(n)


def property_statistics(silver: DataFrame) -> DataFrame:
    """Per property: items, rows, distinct values, first and last time, share of all rows."""
    # The total comes from the grouped rows, one a property, so silver is read once.
    total = F.sum("total_property_records").over(Window.partitionBy(F.lit(0)))
    grouped = silver.groupBy("property_id").agg(
        F.count_distinct("item_id").alias("items_with_property"),
        F.count("*").alias("total_property_records"),
        F.count_distinct("property_value").alias("distinct_values"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
    )
    share = F.round(F.col("total_property_records") / total, 4)
    return grouped.withColumns({"frequency_ratio": share, "computed_at": F.current_timestamp()})


def top_properties(statistics: DataFrame, n: int = 10) -> DataFrame:
    return statistics.orderBy(F.desc("total_property_records"), "property_id").limit(n)


def item_property_lists(silver: DataFrame) -> DataFrame:
    """Per item: row and distinct counts, last date, and aligned lists of ids and values."""
    lists = silver.groupBy("item_id").agg(
        F.sort_array(F.collect_list(F.struct("property_id", "property_value"))).alias("_pairs"),
        F.count("property_id").alias("total_properties"),
        F.max("event_date").alias("last_updated"),
    )
    distinct = F.size(F.array_compact(F.array_distinct("_pairs.property_id"))).cast("bigint")
    return lists.select(
        "item_id",
        "total_properties",
        distinct.alias("unique_properties"),
        "last_updated",
        F.col("_pairs.property_id").alias("property_ids"),
        F.col("_pairs.property_value").alias("property_values"),
    )


def property_count_per_item(silver: DataFrame) -> DataFrame:
    counts = silver.groupBy("item_id").agg(F.count("*").alias("property_count"))
    return counts.orderBy(F.desc("property_count"), "item_id")
