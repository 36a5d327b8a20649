"""The given test tables as item properties and click events, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clock
from tidemark.operators import events as ev
from tidemark.operators import properties as props
from tidemark.schemas import EVENT_CSV


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream; the pattern lets the path be one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def as_item_properties(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        clock.millis_of("l_shipdate").alias("timestamp"),
        F.col("l_partkey").cast("int").alias("itemid"),
        F.col("l_linenumber").alias("property"),
        F.concat("l_returnflag", "l_linestatus").alias("value"),
    )


def as_event_rows(events: DataFrame) -> DataFrame:
    """Event CSV columns as text; every row has a transaction id, as raw data may."""
    event = (
        F.when(F.col("event_type") == "click", "addtocart")
        .when(F.col("event_type") == "purchase", "transaction")
        .otherwise(F.col("event_type"))
    )
    return events.select(
        clock.millis_of("ts").cast("string").alias("timestamp"),
        F.col("user_id").cast("string").alias("visitorid"),
        event.alias("event"),
        F.get_json_object("props", "$.k").alias("itemid"),
        F.concat_ws("-", F.col("user_id"), F.date_format("ts", "yyyyMMdd")).alias("transactionid"),
        F.col("event_id").cast("string").alias("_ingestion_id"),
        (clock.millis_of("ts") + F.round(F.col("value") * 1000).cast("bigint"))
        .cast("string")
        .alias("_ingestion_timestamp"),
    )


def event_files(events: DataFrame) -> DataFrame:
    """Event rows with the file they come from, as the publisher reads them."""
    return as_event_rows(events).select("*", F.col("_metadata.file_path").alias("_source_file"))


def bronze_item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return props.with_ingestion_metadata(as_item_properties(lineitem), "fixture")


def silver_item_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return props.silver_item_properties(bronze_item_properties(spark, sf_dir))


def bronze_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_rows(table(spark, sf_dir, "events"))


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.silver_events(bronze_events(spark, sf_dir))


def bronze_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_rows(table_stream(spark, sf_dir, "events"))


def silver_events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.silver_events(bronze_events_stream(spark, sf_dir))


def land_item_properties(spark: SparkSession, sf_dir: str, landing: str) -> str:
    """Writes the item properties as CSV into a dated folder, as an upload does."""
    rows = as_item_properties(table(spark, sf_dir, "lineitem"))
    rows.write.option("header", True).csv(f"{landing}/2024/01/31")
    return landing


def land_events(spark: SparkSession, sf_dir: str, landing: str) -> str:
    rows = as_event_rows(table(spark, sf_dir, "events")).select(*EVENT_CSV.fieldNames())
    rows.write.option("header", True).csv(f"{landing}/2024/01/31")
    return landing
