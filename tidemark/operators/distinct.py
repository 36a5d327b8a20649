"""Exact distinct counts of integer ids as bitmaps, which add up over loads.

A load is summarised once, into one bitmap of 32,768 ids for each run of ids it holds, and its rows are
not read again. Merging sums of loads gives what ``count_distinct`` gives over all rows; unlike several
``count_distinct`` in one aggregation, no row is expanded: each id column is scanned by itself.

NULL and text that is not an integer count as no id; an empty load adds nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD = "load"


def id_bitmaps(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``name, bucket, bits, records``: the ids of each column by bucket, and all records under a NULL name."""
    text, number, binary = (F.lit(None).cast(kind) for kind in ("string", "bigint", "binary"))
    parts = rows.agg(text.alias("name"), number.alias("bucket"), binary.alias("bits"), F.count("*").alias("records"))
    for name in columns:
        ids = rows.select(F.col(name).try_cast("bigint").alias("id")).filter("id is not null")
        ids = ids.groupBy(F.bitmap_bucket_number("id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), F.count("*").alias("records")
        )
        parts = parts.unionByName(ids.select(F.lit(name).alias("name"), "bucket", "bits", "records"))
    return parts


def add_load(rows: DataFrame, columns: Sequence[str], target: str, load: str) -> None:
    """Stores the bitmaps of one load at ``target``; the same load again replaces them."""
    summed = id_bitmaps(rows, columns).withColumn(LOAD, F.lit(load))
    writer = summed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(LOAD).parquet(target)


def distinct_counts(bitmaps: DataFrame, names: Mapping[str, str], total: str = "total_records") -> DataFrame:
    """One row: all records as ``total``, and for each column the distinct ids under its name in ``names``."""
    records = bitmaps.filter("name is null").agg(F.sum("records").alias("n"))
    merged = bitmaps.filter("name is not null").groupBy("name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = merged.groupBy("name").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    found = counts.unionByName(records.select(F.lit(None).cast("string").alias("name"), "n"))
    number = lambda wanted: F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0)).cast("bigint")
    return found.agg(
        number(F.col("name").isNull()).alias(total),
        *[number(F.col("name") == column).alias(name) for column, name in names.items()],
    )
