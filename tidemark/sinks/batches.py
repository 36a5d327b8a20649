"""Plain tables that a stream writes through ``foreachBatch``, one Spark partition per micro-batch.

The partition columns ``stream, batch_id`` name the query, whose id lives in its checkpoint, and the
micro-batch. A batch overwrites its own partition and no other (dynamic partition overwrite), so a
replay changes nothing, and an executor or driver lost on the way leaves the former partition. Several
streams may write to one table; a new checkpoint is a new stream, whose rows stand beside the earlier.

One query may feed several tables, each with its own write function, from one read of its source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sinks.tables import FORMAT, read_table
from tidemark.streaming.runs import run_to_end

STREAM, BATCH = "stream", "batch_id"
WRITTEN = "written_at"
# Writes a micro-batch of a stream with this id and number.
Write = Callable[[DataFrame, str, int], None]
Change = Callable[[DataFrame], DataFrame]


def feed(
    rows: DataFrame,
    checkpoint: str,
    writes: Sequence[Write],
    mode: str = "append",
    wait: bool = True,
) -> StreamingQuery:
    """Runs every write on each micro-batch, which is read and computed once for all of them.

    The writes are jobs side by side; the batch counts as done when all have ended without error.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if len(writes) == 1:
            return writes[0](batch, stream, batch_id)
        batch.persist()
        try:
            with ThreadPoolExecutor(len(writes)) as jobs:
                started = [jobs.submit(each, batch, stream, batch_id) for each in writes]
            for job in started:
                job.result()
        finally:
            batch.unpersist()

    writer = rows.writeStream.outputMode(mode).foreachBatch(write)
    return run_to_end(writer.option("checkpointLocation", checkpoint), wait=wait)


def overwrite_partitions(
    rows: DataFrame, path: str, partition_by: Sequence[str], fmt: str = FORMAT
) -> None:
    """Replaces the partitions that ``rows`` has, once all of it is written, and leaves the others.

    ``rows`` may come from the same table.
    """
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).format(fmt).save(path)


def write_batch(
    rows: DataFrame,
    path: str,
    stream: str,
    batch_id: int,
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> None:
    """Writes the rows of one micro-batch; ``partition_by`` comes above its own partition."""
    placed = rows.withColumns({STREAM: F.lit(stream), BATCH: F.lit(batch_id).cast("bigint")})
    if partition_by:
        placed = placed.hint("rebalance", *[F.col(name) for name in partition_by])
    overwrite_partitions(placed, path, [*partition_by, STREAM, BATCH], fmt)


def to_batches(
    path: str,
    change: Change = lambda batch: batch,
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> Write:
    """A write of ``change(batch)``."""
    return lambda batch, stream, batch_id: write_batch(
        change(batch), path, stream, batch_id, partition_by, fmt
    )


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = FORMAT
) -> DataFrame:
    """The rows of all micro-batches with ``stream, batch_id``.

    With ``schema``, that of the rows, the table may be empty or not yet be written at all.
    """
    if schema is None:
        return read_table(spark, path, fmt)
    return read_or_empty(
        spark, path, T.StructType([*schema.fields]).add(STREAM, "string").add(BATCH, "long"), fmt
    )


def read_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = FORMAT
) -> DataFrame:
    """A table by path that may hold no row, or may not yet be written."""
    try:
        return read_table(spark, path, fmt, schema=schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


# --- update mode: the groups that changed, latest per key at reading


def update_stream(
    aggregate: DataFrame, path: str, checkpoint: str, fmt: str = FORMAT, wait: bool = True
) -> StreamingQuery:
    """Writes only the groups that changed in each micro-batch; read with ``read_latest``."""

    def write(batch: DataFrame, stream: str, batch_id: int) -> None:
        stamped = batch.withColumn(WRITTEN, F.current_timestamp())
        write_batch(stamped, path, stream, batch_id, fmt=fmt)

    return feed(aggregate, checkpoint, [write], "update", wait)


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], fmt: str = FORMAT
) -> DataFrame:
    """The row of the last micro-batch that touched each key; each task first keeps its own latest.

    Micro-batches of one stream are ordered by number, streams by when they last wrote.
    """
    rows = read_batches(spark, path, fmt=fmt)
    streams = rows.groupBy(STREAM).agg(F.max(WRITTEN).alias("_last"))
    age = Window.partitionBy(*keys).orderBy(F.desc("_last"), F.desc(STREAM), F.desc(BATCH))
    ranked = rows.join(F.broadcast(streams), STREAM).withColumn("_age", F.row_number().over(age))
    return ranked.filter("_age = 1").drop("_age", "_last", WRITTEN, STREAM, BATCH)


# --- complete mode: all groups anew


def replace_stream(
    aggregate: DataFrame, path: str, checkpoint: str, fmt: str = FORMAT, wait: bool = True
) -> StreamingQuery:
    """The complete aggregate after each micro-batch; read with ``read_newest``.

    Odd and even batches take turns in two partitions, so the last finished result is always there.
    """

    def write(batch: DataFrame, stream: str, batch_id: int) -> None:
        turn = F.lit(batch_id % 2).alias("turn")
        overwrite_partitions(batch.select("*", F.current_timestamp().alias(WRITTEN), turn), path, ["turn"], fmt)

    return feed(aggregate, checkpoint, [write], "complete", wait)


def read_newest(spark: SparkSession, path: str, fmt: str = FORMAT) -> DataFrame:
    """The result of the last finished micro-batch."""
    rows = read_table(spark, path, fmt)
    newest = rows.agg(F.max(WRITTEN)).first()[0]
    return rows.filter(F.col(WRITTEN) == F.lit(newest)).drop(WRITTEN, "turn")


# --- sums: aggregates of micro-batches that merge into the aggregate of all


def _lowest_bit(n: int) -> int:
    return n & -n


def covering(n: int) -> list[int]:
    """The partitions that together hold micro-batches 1 to ``n``, newest first.

    Partition ``i`` holds as many batches up to ``i`` as the lowest bit of ``i`` says.
    """
    found = []
    while n > 0:
        found.append(n)
        n -= _lowest_bit(n)
    return found


def merged_into(n: int) -> list[int]:
    """The earlier partitions that partition ``n`` takes up besides its own micro-batch."""
    return [i for i in covering(n - 1) if i > n - _lowest_bit(n)]


def add_batch(
    parts: DataFrame,
    path: str,
    stream: str,
    batch_id: int,
    merge: Change,
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> None:
    """Adds one micro-batch's aggregates; ``merge`` sums rows of the same groups.

    Every second batch takes up the one before it, every fourth the three before, and so on. Only
    partitions are added: a read touches one per bit of the batch number, a row is rewritten once
    per doubling of the history, and a replay finds the earlier partitions unchanged.
    """
    n = batch_id + 1
    if earlier := merged_into(n):
        known = read_batches(parts.sparkSession, path, parts.schema, fmt)
        known = known.filter((F.col(STREAM) == stream) & F.col(BATCH).isin(earlier))
        parts = merge(parts.unionByName(known.drop(STREAM, BATCH)))
    write_batch(parts, path, stream, n, partition_by, fmt)


def to_sums(
    path: str,
    aggregate: Change,
    merge: Change,
    partition_by: Sequence[str] = (),
    fmt: str = FORMAT,
) -> Write:
    """A write that adds ``aggregate(batch)``; ``partition_by`` are group columns to prune by."""
    return lambda batch, stream, batch_id: add_batch(
        aggregate(batch), path, stream, batch_id, merge, partition_by, fmt
    )


def read_sums(
    spark: SparkSession,
    path: str,
    merge: Change,
    schema: T.StructType | None = None,
    where: Column | None = None,
    fmt: str = FORMAT,
) -> DataFrame:
    """The aggregates of all micro-batches, from the partitions that cover them.

    ``where``, a condition on group columns, is taken before the merge.
    """
    rows = read_batches(spark, path, schema, fmt)
    newest = rows.groupBy(STREAM).agg(F.max(BATCH)).collect()  # a row per checkpoint ever used
    wanted = F.lit(False)
    for stream, n in newest:
        wanted = wanted | ((F.col(STREAM) == stream) & F.col(BATCH).isin(covering(n)))
    if where is not None:
        wanted = wanted & where
    return merge(rows.filter(wanted).drop(STREAM, BATCH))
