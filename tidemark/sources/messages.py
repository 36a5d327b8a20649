"""Keyed JSON event messages: publishing them from CSV rows, and reading them as a stream."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.functions import clock, validation
from tidemark.schemas import EVENT_CSV, MESSAGE_ENVELOPE
from tidemark.streaming.runs import run_to_end

_SOURCE = "_source_file"


def _load_uuid(load_id: str):
    """One UUID per source file and load, the same for every row of the file."""
    digest = F.md5(F.concat(F.lit(load_id), F.col(_SOURCE)))
    return F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")


def event_records(
    rows: DataFrame,
    load_id: str | None = None,
    event_types: Sequence[str] | None = None,
) -> DataFrame:
    """Trimmed and checked event rows with their publishing metadata.

    ``rows`` has the CSV columns as text and ``_source_file``. Invalid rows stay, with a reason.
    """
    trimmed = rows.select(
        *[F.trim(name).alias(name) for name in EVENT_CSV.fieldNames()], _SOURCE
    ).withColumns(
        {
            "_ingestion_id": _load_uuid(load_id or uuid.uuid4().hex),
            "_ingestion_timestamp": F.unix_millis(F.current_timestamp()),
        }
    )
    return validation.with_status(trimmed, validation.event_error(event_types))


def to_messages(records: DataFrame) -> DataFrame:
    """``key`` (the item id), JSON ``value`` and the validation columns.

    The key is left to the sink: shuffling by it here would put a hot item into one task.
    """
    fields = [*EVENT_CSV.fieldNames()[1:], "_ingestion_id", "_ingestion_timestamp", _SOURCE]
    valid = F.to_json(F.struct(clock.millis("timestamp").alias("timestamp"), *fields))
    rejected = F.to_json(F.struct(*EVENT_CSV.fieldNames(), _SOURCE))
    is_valid = F.col("validation_status") == validation.PASSED
    return records.select(
        F.col("itemid").alias("key"),
        F.when(is_valid, valid).otherwise(rejected).alias("value"),
        "validation_status",
        "validation_error",
    )


def in_envelope(messages: DataFrame) -> DataFrame:
    """Messages in the columns that the stream source delivers."""
    return messages.select(
        F.col("value").cast("binary").alias("data"),
        F.current_timestamp().alias("approximateArrivalTimestamp"),
        F.col("key").alias("partitionKey"),
        "validation_status",
        "validation_error",
    )


class LoadCounts(StreamingQueryListener):
    """Messages sent and rejected by one load, as its query reports them for each micro-batch.

    The counts come with the rows, from the pass that publishes them; ``name`` tells loads apart
    that run at the same time.
    """

    def __init__(self) -> None:
        self.name = f"published_{uuid.uuid4().hex}"
        self.batches: dict[int, tuple[int, int]] = {}
        self._ended: set[str] = set()
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        seen = event.progress.observedMetrics.get(self.name)
        if seen is not None:
            self.batches[event.progress.batchId] = (seen["successful"], seen["failed"])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def totals(self, query: StreamingQuery, timeout: float = 60) -> dict[str, int]:
        """``{successful, failed}`` of all micro-batches of the query, which has ended."""
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, timeout):
                raise TimeoutError("the end of the load was not reported")
        return {
            "successful": sum(sent for sent, _ in self.batches.values()),
            "failed": sum(rejected for _, rejected in self.batches.values()),
        }


def publish_events(
    rows: DataFrame,
    log: str,
    checkpoint: str,
    load_id: str | None = None,
    counts: LoadCounts | None = None,
) -> StreamingQuery:
    """Publishes a stream of CSV rows to a file-based message log, once each.

    Valid and rejected rows go to two partitions of the log in a single pass, which also fills
    ``counts``.
    """
    messages = in_envelope(to_messages(event_records(rows, load_id)))
    status = F.col("validation_status")
    if counts is not None:
        messages = messages.observe(
            counts.name,
            F.count(F.when(status == validation.PASSED, 1)).alias("successful"),
            F.count(F.when(status == validation.FAILED, 1)).alias("failed"),
        )
        rows.sparkSession.streams.addListener(counts)
    try:
        query = run_to_end(
            messages.writeStream.format("parquet")
            .partitionBy("validation_status")
            .option("path", log)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
        )
        if counts is not None:
            counts.totals(query)
        return query
    finally:
        if counts is not None:
            rows.sparkSession.streams.removeListener(counts)


def message_stream(spark: SparkSession, log: str, max_files: int | None = None) -> DataFrame:
    """The valid messages of a file-based log, as a stream."""
    schema = T.StructType([*MESSAGE_ENVELOPE.fields, T.StructField("validation_status", T.StringType())])
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    messages = reader.parquet(log)
    return messages.filter(F.col("validation_status") == validation.PASSED).select(
        *MESSAGE_ENVELOPE.fieldNames()
    )


def rejected_messages(spark: SparkSession, log: str) -> DataFrame:
    """The quarantined rows of a file-based log, as text with the reason."""
    log_rows = spark.read.parquet(log)
    return log_rows.filter(F.col("validation_status") == validation.FAILED).select(
        F.col("data").cast("string").alias("row"), "validation_error"
    )


def broker_stream(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """Messages of a broker connector on the class path, in the envelope columns.

    Credentials belong to the environment of the connector, not to the options.
    """
    raw = spark.readStream.format(fmt).options(**options).load()
    names = {"value": "data", "timestamp": "approximateArrivalTimestamp", "key": "partitionKey"}
    renamed = raw.withColumnsRenamed(names)
    return renamed.select(
        "data", "approximateArrivalTimestamp", F.col("partitionKey").cast("string")
    )
