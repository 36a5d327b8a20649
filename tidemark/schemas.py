"""Column contracts of the ingested files and messages."""

from pyspark.sql import types as T

PROPERTY_CSV = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("itemid", T.IntegerType()),
        T.StructField("property", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)

ITEM_BRONZE = T.StructType(
    [
        *PROPERTY_CSV.fields,
        T.StructField("_ingestion_time", T.TimestampType()),
        T.StructField("_source_file", T.StringType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

ITEM_SILVER = T.StructType(
    [
        T.StructField("timestamp_unix", T.LongType()),
        T.StructField("event_time", T.TimestampNTZType()),
        T.StructField("item_id", T.IntegerType()),
        T.StructField("property_id", T.IntegerType()),
        T.StructField("property_value", T.StringType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("event_year", T.IntegerType()),
        T.StructField("event_month", T.IntegerType()),
    ]
)

# Read as text so that a bad cell can be reported instead of silently becoming NULL.
EVENT_CSV = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("timestamp", "visitorid", "event", "itemid", "transactionid")
    ]
)

EVENT_MESSAGE = T.StructType(
    [
        *EVENT_CSV.fields,
        T.StructField("_ingestion_id", T.StringType()),
        T.StructField("_ingestion_timestamp", T.StringType()),
        T.StructField("_source_file", T.StringType()),
    ]
)

EVENT_BRONZE = T.StructType(
    [
        *EVENT_MESSAGE.fields,
        T.StructField("kinesis_timestamp", T.TimestampType()),
        T.StructField("_processing_time", T.TimestampType()),
    ]
)

MESSAGE_ENVELOPE = T.StructType(
    [
        T.StructField("data", T.BinaryType()),
        T.StructField("approximateArrivalTimestamp", T.TimestampType()),
        T.StructField("partitionKey", T.StringType()),
    ]
)

# The event names the silver layer keeps, and the longer documented list.
EVENT_TYPES = ("view", "addtocart", "transaction")
DOCUMENTED_EVENT_TYPES = ("view", "click", "purchase", "add_to_cart", "remove_from_cart")
