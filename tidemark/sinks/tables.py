"""Tables by catalog name or by path: scans, streaming reads, overwrites and appends.

A target with a ``/`` is a path, any other a catalog table. The format is Parquet by default and a
parameter everywhere; with a transactional format the same calls work unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.streaming.runs import run_to_end

FORMAT = "parquet"


def _is_path(target: str) -> bool:
    return "/" in target


def read_table(
    spark: SparkSession,
    target: str,
    fmt: str = FORMAT,
    merge_schema: bool = False,
    schema: StructType | None = None,
) -> DataFrame:
    """A whole table; ``merge_schema`` also sees columns that only later files have.

    A path may hold no file yet, as after a partitioned write of no rows, if ``schema`` is given.
    """
    if not _is_path(target):
        return spark.table(target)
    reader = spark.read.option("mergeSchema", merge_schema).format(fmt)
    return (reader.schema(schema) if schema else reader).load(target)


def stream_table(
    spark: SparkSession,
    target: str,
    fmt: str = FORMAT,
    max_files: int | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A table as an unbounded append log; a path that may hold no file yet needs ``schema``."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if not _is_path(target):
        return reader.table(target)
    schema = schema or read_table(spark, target, fmt).schema
    return reader.schema(schema).format(fmt).load(target)


def _widened(rows: DataFrame, target: str) -> DataFrame:
    """``rows`` with all columns of the catalog table, which first gets those it lacks."""
    spark = rows.sparkSession
    known = {name.lower() for name in spark.table(target).columns}
    new = [field for field in rows.schema if field.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({columns})")
    present = {name.lower() for name in rows.columns}
    return rows.select(
        *[
            F.col(f.name) if f.name.lower() in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(target).schema
        ]
    )


def write_table(
    rows: DataFrame,
    target: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> int:
    """Overwrites or appends, and returns the number of rows written, counted in the same pass.

    A partitioned table is rebalanced by its partition columns: each partition gets few files, and
    AQE splits a partition that holds much of the data over several tasks. An unpartitioned table is
    rebalanced to files of the advisory size. Nothing is coalesced to a fixed number of tasks.

    An append to a catalog table adds the columns that only ``rows`` has, and fills with NULL those
    that only the table has; by path, ``read_table(merge_schema=True)`` does the same at reading.
    """
    if mode == "append" and not _is_path(target) and rows.sparkSession.catalog.tableExists(target):
        rows = _widened(rows, target)
    written = Observation()
    balanced = rows.hint("rebalance", *[F.col(name) for name in partition_by])
    counted = balanced.observe(written, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)
    return written.get["rows"]


def append_stream(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> StreamingQuery:
    """Appends each row of a stream once.

    Before it starts, a catalog table gets the columns that only ``rows`` has, and ``rows`` those that
    only the table has, as NULL. So a stream that is started again with a wider source goes on.
    """
    if not _is_path(target) and rows.sparkSession.catalog.tableExists(target):
        rows = _widened(rows, target)
    writer = (
        rows.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if _is_path(target):
        return run_to_end(writer.option("path", target))
    return run_to_end(writer, target)
