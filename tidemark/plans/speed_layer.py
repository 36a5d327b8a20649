"""The speed layer: landing files to messages, bronze, silver and gold tables.

Each step drains what is new since its own checkpoint, so the steps can run at different times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions import validation
from tidemark.operators import events as ev
from tidemark.schemas import EVENT_BRONZE, EVENT_CSV
from tidemark.sinks.batches import feed
from tidemark.sinks.tables import append_stream, read_table, stream_table
from tidemark.sources.files import stream_csv
from tidemark.sources.messages import message_stream, publish_events
from tidemark.streaming import gold


def publish(spark: SparkSession, landing: str, home: str) -> None:
    rows = stream_csv(spark, landing, EVENT_CSV).select(
        "*", F.col("_metadata.file_path").alias("_source_file")
    )
    publish_events(rows, f"{home}/messages", f"{home}/checkpoints/messages")


def to_bronze(spark: SparkSession, home: str) -> None:
    """Parsed messages and those that do not parse, in one pass, as two partitions."""
    parsed = ev.checked_bronze_events(message_stream(spark, f"{home}/messages"))
    append_stream(parsed, f"{home}/bronze", f"{home}/checkpoints/bronze", ["payload_status"])


BRONZE_LOG = StructType([*EVENT_BRONZE.fields]).add("payload", "string").add("payload_status", "string")


def _bronze(spark: SparkSession, home: str) -> DataFrame:
    parsed = stream_table(spark, f"{home}/bronze", schema=BRONZE_LOG)
    # A table without the column, such as one from before the quarantine, has no failed rows.
    passed = parsed.filter(~F.col("payload_status").eqNullSafe(validation.FAILED))
    return passed.select(*EVENT_BRONZE.fieldNames())


def malformed_payloads(spark: SparkSession, home: str) -> DataFrame:
    """The messages that bronze could not parse, raw, from their own partition."""
    log = read_table(spark, f"{home}/bronze", schema=BRONZE_LOG)
    return log.filter(F.col("payload_status") == validation.FAILED).select(
        "payload", "kinesis_timestamp"
    )


def to_silver(spark: SparkSession, home: str) -> None:
    silver = ev.silver_events(_bronze(spark, home))
    append_stream(silver, f"{home}/silver", f"{home}/checkpoints/silver")


GOLD_SUMS = {
    "visitor_profile": gold.PROFILES,
    "item_cooccurrence": gold.BASKETS,
    "event_metrics": gold.METRICS,
    "visitor_behavior": gold.BEHAVIOR,
    "item_popularity": gold.POPULARITY,
}


def _silver_schema(spark: SparkSession) -> StructType:
    return ev.silver_events(spark.createDataFrame([], EVENT_BRONZE)).schema


def to_gold(spark: SparkSession, home: str) -> None:
    """One query over silver feeds all gold tables, so that each event is read once."""
    silver = stream_table(spark, f"{home}/silver", schema=_silver_schema(spark))
    writes = [table.write(f"{home}/{name}") for name, table in GOLD_SUMS.items()]
    writes.append(gold.journey_write(f"{home}/customer_journey"))
    feed(silver, f"{home}/checkpoints/gold", writes)


def read_gold(spark: SparkSession, home: str) -> dict[str, DataFrame]:
    events = _silver_schema(spark)
    tables = {name: t.read(spark, f"{home}/{name}", events) for name, t in GOLD_SUMS.items()}
    tables["item_cooccurrence"] = ev.baskets(tables["item_cooccurrence"])
    journeys = gold.read_journeys(spark, f"{home}/customer_journey", events=events)
    return tables | {"customer_journey": journeys}


def run(spark: SparkSession, landing: str, home: str) -> dict[str, DataFrame]:
    """Publish, ingest, refine, aggregate; returns the gold tables."""
    publish(spark, landing, home)
    to_bronze(spark, home)
    to_silver(spark, home)
    to_gold(spark, home)
    return read_gold(spark, home)
