"""The batch layer: landing files to bronze, silver and gold tables.

Every target is a catalog table name or a path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import properties as props
from tidemark.operators import quality
from tidemark.operators.skew import numbered
from tidemark.schemas import ITEM_BRONZE, ITEM_SILVER, PROPERTY_CSV
from tidemark.session import workspace
from tidemark.sinks.batches import feed, overwrite_partitions, read_or_empty
from tidemark.sinks.tables import append_stream, read_table, stream_table, write_table
from tidemark.sources.files import stream_csv

SILVER_PARTITIONS = ("event_year", "event_month", "event_date")
SILVER_KEYS = ("item_id", "property_id")
BUCKET = "item_bucket"


def _read_silver(spark: SparkSession, silver: str) -> DataFrame:
    return read_table(spark, silver, schema=ITEM_SILVER)


def _latest(typed: DataFrame) -> DataFrame:
    """``latest_item_properties``, with a number for each file's path while rows are sorted.

    The path is the widest column, and settles only ties. Files are numbered in the order of their
    paths, so the numbers settle them alike; rows get their path again when one a key is left.
    """
    spark, path = typed.sparkSession, workspace(typed.sparkSession, "source-files")
    files = numbered(typed.select("source_file").distinct(), [], ["source_file"], "_file")
    files.write.parquet(path)
    files = spark.read.schema(files.schema).parquet(path)
    same = F.col("source_file").eqNullSafe(F.col("_path"))
    coded = typed.join(files.withColumnRenamed("source_file", "_path"), same)
    coded = coded.withColumn("source_file", F.col("_file")).select(*props.TYPED)
    latest = props.latest_item_properties(coded).withColumnRenamed("source_file", "_file")
    return latest.join(files, "_file").select(*ITEM_SILVER.fieldNames())


def ingest(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Appends the files that have landed since the last run."""
    rows = props.with_ingestion_metadata(stream_csv(spark, landing, PROPERTY_CSV, max_files))
    return append_stream(rows, bronze, checkpoint)


def refine(
    spark: SparkSession,
    bronze: str,
    silver: str,
    partition_by: Sequence[str] = SILVER_PARTITIONS,
) -> int:
    """Rebuilds silver from all of bronze; returns its row count.

    The rows are staged and checked in the pass that writes them. If a key is NULL, the old silver
    stays as it is.
    """
    checked, staged = Observation(), workspace(spark, "silver-staged")
    rows = _latest(props.typed_item_properties(read_table(spark, bronze)))
    rows.observe(checked, *quality.null_key_counts(SILVER_KEYS)).write.parquet(staged)
    if any(checked.get.values()):
        raise ValueError(f"NULL keys for {silver}: {checked.get}")
    return write_table(
        read_table(spark, staged, schema=ITEM_SILVER), silver, partition_by=partition_by
    )


def _read_buckets(spark: SparkSession, silver: str) -> DataFrame:
    schema = T.StructType([*ITEM_SILVER.fields]).add(BUCKET, "integer")
    return read_or_empty(spark, silver, schema)


def refine_new(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    buckets: int = 256,
    max_files: int | None = None,
) -> StreamingQuery:
    """Merges the bronze rows that are new since the last run into silver.

    Silver is partitioned by a hash of the item. Only the buckets that new rows fall into are read,
    merged and rewritten, each with its former and its new rows; a replayed batch gives the same
    rows, and a NULL key fails the job before any bucket is replaced. ``buckets`` must not change
    over the life of the table.
    """

    def merge(batch: DataFrame, stream: str, batch_id: int) -> None:
        bucket = F.pmod(F.hash("item_id"), F.lit(buckets)).alias(BUCKET)
        fresh = props.typed_item_properties(batch).select("*", bucket)
        touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]
        known = _read_buckets(spark, silver).filter(F.col(BUCKET).isin(touched))
        rows = fresh.unionByName(known.select(*props.TYPED, BUCKET))
        latest = _latest(rows.drop(BUCKET)).select("*", bucket)
        present = quality.with_keys_present(latest, SILVER_KEYS)
        overwrite_partitions(present.hint("rebalance", F.col(BUCKET)), silver, [BUCKET])

    new = stream_table(spark, bronze, max_files=max_files, schema=ITEM_BRONZE)
    return feed(new, checkpoint, [merge])


def aggregate(
    spark: SparkSession, silver: str, summary: str, statistics: str
) -> dict[str, int]:
    """Rebuilds both gold tables; returns their row counts."""
    rows = _read_silver(spark, silver)
    return {
        summary: write_table(props.item_property_summary(rows), summary),
        statistics: write_table(props.property_statistics(rows), statistics),
    }


def run(
    spark: SparkSession,
    landing: str,
    checkpoint: str,
    bronze: str,
    silver: str,
    summary: str,
    statistics: str,
    partition_by: Sequence[str] = SILVER_PARTITIONS,
) -> dict[str, int]:
    """Ingest, refine, aggregate; returns the rows written per rebuilt table."""
    ingest(spark, landing, bronze, checkpoint)
    written = {silver: refine(spark, bronze, silver, partition_by)}
    return written | aggregate(spark, silver, summary, statistics)
