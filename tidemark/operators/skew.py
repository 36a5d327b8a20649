"""Numbering groups of any size: one plan, whatever share of the rows a key holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import workspace


def same_keys(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of key lists in which NULL equals NULL."""
    condition = F.lit(True)
    for a, b in zip(left, right):
        condition = condition & F.col(a).eqNullSafe(F.col(b))
    return condition


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1..n within each key group, by the columns ``order`` with NULLs first.

    Rows are dealt by ranges of key and order, so a group of any size is spread over many tasks, and
    numbered range by range, each shifted by the rows the group has in earlier ranges. The ranges are
    stored with their number first: counts and numbers then see the same split, also when the work of
    a lost executor is repeated.
    """
    spark = rows.sparkSession
    path = workspace(spark, "numbered")
    ascending = [F.col(column).asc_nulls_first() for column in (*keys, *order)]
    dealt = rows.repartitionByRange(*ascending).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    stored = spark.read.schema(dealt.schema).parquet(path)

    parts = [*keys, "_range"]
    earlier = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row a range: only its first group can have begun in an earlier one.
    offsets = (
        stored.groupBy(*parts)
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .filter(F.col("_before").isNotNull())
        .select(*[F.col(part).alias(f"_of_{part}") for part in parts], "_before")
    )
    position = F.row_number().over(
        Window.partitionBy(*parts).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    )
    shifted = stored.withColumn(name, position.cast("bigint")).join(
        F.broadcast(offsets), same_keys(parts, [f"_of_{part}" for part in parts]), "left"
    )
    return shifted.select(
        *rows.columns, (F.col(name) + F.coalesce("_before", F.lit(0))).alias(name)
    )
