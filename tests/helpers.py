"""Small frames for the tests."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EVENT_CSV

DAY_MS = 86_400_000
START_MS = 1_700_000_000_000

BRONZE = "timestamp long, itemid int, property int, value string"
EVENT_BRONZE = T.StructType(
    [*EVENT_CSV.fields, T.StructField("_ingestion_id", T.StringType())]
)


def bronze_properties(spark, rows):
    frame = spark.createDataFrame(rows, BRONZE)
    loaded = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")
    return frame.withColumns({"_ingestion_time": loaded, "_source_file": F.lit("f")})


def bronze_events(spark, rows):
    """Rows of (timestamp, visitorid, event, itemid, transactionid)."""
    numbered = [(*row, f"{i:05}") for i, row in enumerate(rows)]
    return spark.createDataFrame(numbered, EVENT_BRONZE)


def tuples(frame, *columns):
    rows = [tuple(row) for row in frame.select(*columns).collect()]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))
