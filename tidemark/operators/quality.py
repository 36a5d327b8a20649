"""Completeness, freshness, rate and lineage checks, each one distributed aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock


def completeness(bronze: DataFrame) -> DataFrame:
    """Rows and present values per column of the raw item properties."""
    present = [
        F.count(name).alias(f"has_{name}") for name in ("timestamp", "itemid", "property", "value")
    ]
    return bronze.agg(
        F.count("*").alias("total_records"),
        *present,
        F.count_if(F.col("timestamp").isNull()).alias("missing_timestamp"),
    )


def stored_completeness(spark: SparkSession, path: str) -> DataFrame:
    """``completeness`` of a Parquet table of typed columns, from the counts in the footers alone.

    Only the V2 reader takes counts from footers; it is chosen in a session of its own, so that the
    caller's settings stay. Partition filters still apply, filters on rows would not.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    names = ("timestamp", "itemid", "property", "value")
    counts = session.read.parquet(path).agg(
        F.count("*").alias("total_records"), *[F.count(name).alias(f"has_{name}") for name in names]
    )
    return counts.withColumn("missing_timestamp", F.col("total_records") - F.col("has_timestamp"))


def silver_quality(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("total_records"),
        F.count_distinct("item_id").alias("unique_items"),
        F.count_distinct("property_id").alias("unique_properties"),
        F.min("event_time").alias("earliest_event"),
        F.max("event_time").alias("latest_event"),
        F.count_distinct("event_date").alias("date_range"),
    )


def null_key_counts(keys: Sequence[str] = ("item_id", "property_id")) -> list[Column]:
    return [F.count(F.when(F.col(key).isNull(), 1)).alias(f"null_{key}") for key in keys]


def null_key_check(silver: DataFrame) -> DataFrame:
    return silver.agg(*null_key_counts())


def with_keys_present(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``; a job that meets a NULL key fails, before what it writes is published."""
    types = dict(rows.dtypes)
    return rows.withColumns(
        {k: F.coalesce(k, F.raise_error(F.lit(f"NULL in {k}")).cast(types[k])) for k in keys}
    )


def dedup_ratio(bronze: DataFrame) -> DataFrame:
    """Raw rows against silver rows, in one pass; NULL ratio where nothing is left."""
    counts = bronze.agg(
        F.count("*").alias("input_rows"),
        F.count_distinct("itemid", "property").alias("output_rows"),
    )
    return counts.withColumn(
        "dedup_ratio", F.col("input_rows") / F.nullif(F.col("output_rows"), F.lit(0))
    )


def events_overview(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("visitorid").alias("unique_visitors"),
        F.count_distinct("itemid").alias("unique_items"),
    )


def preview(rows: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    return rows.orderBy(*[F.col(name).asc_nulls_first() for name in order]).limit(n)


def data_freshness(bronze: DataFrame, column: str = "_ingestion_timestamp") -> DataFrame:
    """The latest ingestion time, in milliseconds for the text column of the events."""
    return bronze.agg(F.max(clock.millis(column)).alias("last_ingestion_ms"))


def ingestion_rate_daily(bronze: DataFrame, days: int = 7) -> DataFrame:
    """Rows ingested per UTC day, the last ``days`` days first."""
    day = F.to_date(clock.event_time("_ingestion_timestamp"))
    counts = bronze.groupBy(day.alias("ingestion_date")).agg(F.count("*").alias("record_count"))
    return counts.orderBy(F.col("ingestion_date").desc_nulls_last()).limit(days)


def ingestion_rate_hourly(bronze: DataFrame) -> DataFrame:
    """Rows ingested per UTC hour, the latest hour first."""
    hour = clock.hour_start("_ingestion_timestamp").alias("ingestion_hour")
    counts = bronze.groupBy(hour).agg(F.count("*").alias("records"))
    return counts.orderBy(F.col("ingestion_hour").desc_nulls_last())


def validation_report(checked: DataFrame, *by: str) -> DataFrame:
    """Rows per status and reason, and per further columns such as the source file."""
    return checked.groupBy(*by, "validation_status", "validation_error").agg(
        F.count("*").alias("record_count")
    )


def validation_error_count(checked: DataFrame) -> DataFrame:
    failed = checked.filter(F.col("validation_status") == "failed")
    return failed.agg(F.count("*").alias("errors"))


def gold_lineage(tables: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """One row per ``(name, table, key column)``: rows, distinct keys and last refresh."""
    rows = [
        table.agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("record_count"),
            F.count_distinct(key).alias("unique_items"),
            F.max("computed_at").alias("last_refresh"),
        )
        for name, table, key in tables
    ]
    lineage = rows[0]
    for row in rows[1:]:
        lineage = lineage.union(row)
    return lineage
