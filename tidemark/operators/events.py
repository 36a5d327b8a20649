"""Click events: message parsing, the silver layer and the per-key gold tables.

Functions without a window or a list work on batch and streaming frames alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import clock, validation
from tidemark.operators import skew
from tidemark.schemas import EVENT_MESSAGE, EVENT_TYPES

JOURNEY_KEYS = ["visitorid", "itemid"]


def bronze_events(messages: DataFrame) -> DataFrame:
    """JSON payloads as columns, with arrival and processing time; bad JSON gives NULLs."""
    return checked_bronze_events(messages).drop("payload", "payload_status")


def checked_bronze_events(messages: DataFrame) -> DataFrame:
    """Bronze events with ``payload_status``, and the raw ``payload`` of a message that failed.

    A message fails if it has no payload or one that is not a JSON object of the event's fields, as
    a truncated one; what could be read of it is kept in the other columns.
    """
    text = F.col("data").cast("string")
    schema = T.StructType([*EVENT_MESSAGE.fields, T.StructField("_malformed", T.StringType())])
    parsed = F.from_json(text, schema, {"columnNameOfCorruptRecord": "_malformed"})
    failed = text.isNull() | F.col("event_data").isNull() | F.col("event_data._malformed").isNotNull()
    return messages.select(
        parsed.alias("event_data"),
        F.col("approximateArrivalTimestamp").alias("kinesis_timestamp"),
        text.alias("_text"),
        "data",
    ).select(
        *[F.col(f"event_data.{name}") for name in EVENT_MESSAGE.fieldNames()],
        "kinesis_timestamp",
        F.current_timestamp().alias("_processing_time"),
        F.when(failed, F.col("_text")).alias("payload"),
        F.when(failed, validation.FAILED).otherwise(validation.PASSED).alias("payload_status"),
    )


def events_renamed(bronze: DataFrame) -> DataFrame:
    """The renamed projection of the exploratory ingest."""
    return bronze.select(
        F.col("kinesis_timestamp").alias("kinesis_time"),
        F.col("timestamp").alias("event_time"),
        F.col("visitorid").alias("visitor_id"),
        F.col("event").alias("event_type"),
        F.col("itemid").alias("item_id"),
        F.col("transactionid").alias("transaction_id"),
    )


def silver_events(
    bronze: DataFrame,
    event_types: Sequence[str] = EVENT_TYPES,
    purchase: str = "transaction",
) -> DataFrame:
    """Known events with their UTC time; the transaction id is kept on purchases only."""
    return bronze.filter(F.col("event").isin(*event_types)).withColumns(
        {
            "event_time": clock.event_time("timestamp"),
            "transactionid": F.when(F.col("event") == purchase, F.col("transactionid")),
        }
    )


def silver_events_validated(
    bronze: DataFrame, event_types: Sequence[str] = EVENT_TYPES, any_case: bool = False
) -> DataFrame:
    """The documented silver contract: required fields, known events, lower case, date and hour.

    As documented, events are told apart before they are lower-cased; with ``any_case``, after.
    """
    event = F.lower("event") if any_case else F.col("event")
    kept = bronze.filter(
        F.col("timestamp").isNotNull() & F.col("visitorid").isNotNull() & event.isin(*event_types)
    )
    return kept.withColumns(
        {"event": F.lower("event"), "event_time": clock.event_time("timestamp")}
    ).withColumns({"event_date": F.to_date("event_time"), "event_hour": F.hour("event_time")})


def with_latency(bronze: DataFrame) -> DataFrame:
    """Exploratory silver columns: required fields present, typed keys, date and latency."""
    kept = bronze.filter(
        F.col("timestamp").isNotNull() & F.col("visitorid").isNotNull() & F.col("event").isNotNull()
    )
    return kept.withColumns(
        {
            "event_timestamp": clock.millis("timestamp"),
            "item_id": F.expr("try_cast(itemid AS INT)"),
            "ingestion_latency_seconds": clock.latency_seconds(
                "_ingestion_timestamp", "timestamp"
            ),
            "event_date": F.to_date(clock.event_time("timestamp")),
        }
    )


def _is(event: str) -> Column:
    return F.col("event") == event


def visitor_profile(events: DataFrame, approximate: bool = False) -> DataFrame:
    """Per visitor: views, distinct items viewed, add-to-carts, and whether anything was bought.

    ``approximate`` counts distinct items with a fixed-size sketch, as a stream needs it.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return events.groupBy("visitorid").agg(
        F.count_if(_is("view")).alias("total_viewcount"),
        distinct(F.when(_is("view"), F.col("itemid"))).alias("unique_items_viewed"),
        F.count_if(_is("addtocart")).alias("total_addtocart"),
        (F.count_if(_is("transaction")) > 0).cast("int").alias("bought_something"),
    )


def profile_parts(events: DataFrame) -> DataFrame:
    """Profiles of some events that merge with those of others: counts, and a sketch of the items."""
    return events.groupBy("visitorid").agg(
        F.count_if(_is("view")).alias("total_viewcount"),
        F.count_if(_is("addtocart")).alias("total_addtocart"),
        F.max(_is("transaction").cast("int")).alias("bought_something"),
        F.hll_sketch_agg(F.when(_is("view"), F.col("itemid"))).alias("viewed_items"),
    )


def profiles_of_parts(parts: DataFrame) -> DataFrame:
    return parts.select(
        "visitorid",
        "total_viewcount",
        F.hll_sketch_estimate("viewed_items").alias("unique_items_viewed"),
        "total_addtocart",
        "bought_something",
    )


def with_position(events: DataFrame) -> tuple[DataFrame, list[str]]:
    """Events with their time as a number, and the columns that put a journey in order.

    After the time come all columns that can tell two events of the same instant apart. Events
    without a valid time get a number below all others.
    """
    ties = ("event", "transactionid", "_ingestion_timestamp", "_ingestion_id", "_source_file")
    time = F.coalesce(clock.millis("timestamp"), F.lit(clock.FIRST_MS - 1))
    present = [name for name in ties if name in events.columns]
    return events.withColumn("_at", time), ["_at", *present]


def customer_journey(events: DataFrame) -> DataFrame:
    """Events numbered in time order within each visitor and item."""
    timed, position = with_position(events)
    return skew.numbered(timed, JOURNEY_KEYS, position, "event_order").drop("_at")


def visitor_journey(events: DataFrame, visitor: str) -> DataFrame:
    """One visitor's numbered events in time order, filtered before the numbering."""
    journey = customer_journey(events.filter(F.col("visitorid") == visitor))
    return journey.orderBy("event_time", "itemid", "event_order")


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(_is("transaction")).select("transactionid", "itemid")


def basket_items(bought: DataFrame) -> DataFrame:
    """Baskets in long form, the form to store: ``transactionid, itemid, copies``."""
    return bought.groupBy("transactionid", "itemid").agg(F.count("*").alias("copies"))


def baskets(items: DataFrame) -> DataFrame:
    """Long baskets as one sorted list per transaction, duplicates kept and NULL items left out.

    A task collects the distinct items of a basket with their copies. A list that exceeds what one
    cell can hold fails the query.
    """
    bought = F.when(F.col("itemid").isNotNull(), F.struct("itemid", "copies"))
    lists = items.groupBy("transactionid").agg(F.sort_array(F.collect_list(bought)).alias("_items"))
    copied = F.transform(
        "_items", lambda item: F.array_repeat(item["itemid"], item["copies"].cast("int"))
    )
    return lists.select("transactionid", F.flatten(copied).alias("items_bought_together"))


def item_cooccurrence(events: DataFrame) -> DataFrame:
    """The baskets of all purchase events."""
    return baskets(basket_items(purchases(events)))


def baskets_containing(items: DataFrame, item: str) -> DataFrame:
    """The rows of those long baskets that hold ``item``, whatever their size."""
    wanted = items.filter(F.col("itemid") == item)
    wanted = wanted.select(F.col("transactionid").alias("_wanted"))
    return items.join(wanted, skew.same_keys(["transactionid"], ["_wanted"]), "left_semi")


def baskets_with_item(events: DataFrame, item: str) -> DataFrame:
    """Whole baskets that contain ``item``; only their rows become lists."""
    return baskets(baskets_containing(basket_items(purchases(events)), item))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event").agg(F.count("*").alias("event_count"))


def event_timeline(events: DataFrame) -> DataFrame:
    counts = events.groupBy("event_time").agg(F.count("*").alias("event_count"))
    return counts.orderBy(F.col("event_time").asc_nulls_first())


def top_by_events(events: DataFrame, key: str, n: int = 20) -> DataFrame:
    counts = events.groupBy(key).agg(F.count("*").alias("event_count"))
    return counts.orderBy(F.desc("event_count"), key).limit(n)


def top_viewers(profiles: DataFrame, n: int = 20) -> DataFrame:
    return profiles.orderBy(F.desc("total_viewcount"), "visitorid").limit(n)
