"""Distinct counts from bitmaps of loads, and counts from footers."""

import random

from pyspark.sql import functions as F

from tidemark.operators import distinct, quality
from tidemark.plans import fixtures
from tidemark.sinks.tables import read_table, write_table

SF_DIR = "/root/testdata/sf0.001"
NAMES = {"a": "distinct_a", "b": "distinct_b"}


def frame(spark, rows):
    return spark.createDataFrame(rows, "a bigint, b string")


def plan(rows):
    return rows._jdf.queryExecution().toString()


def test_bitmaps_of_loads_add_up(spark, tmp_path):
    rng = random.Random(3)
    ids = [0, 1, -1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**62, -(2**62), None]
    loads = [[(rng.choice(ids), rng.choice(["7", "-7", "x", "", None, " 8", "40000"])) for _ in range(60)] for _ in range(4)]
    loads.append([])
    for i, load in enumerate([*loads, loads[1]]):
        distinct.add_load(frame(spark, load), ["a", "b"], str(tmp_path / "bitmaps"), f"load-{i % 5 if i < 5 else 1}")
    got = distinct.distinct_counts(read_table(spark, str(tmp_path / "bitmaps")), NAMES).first().asDict()
    rows = [row for load in loads for row in load]
    whole = frame(spark, rows).agg(
        F.count("*").alias("total_records"), F.count_distinct("a").alias("distinct_a"),
        F.count_distinct(F.col("b").try_cast("bigint")).alias("distinct_b"),
    )
    assert got == whole.first().asDict() and got["distinct_a"] == 10 and got["distinct_b"] == 4


def test_bitmaps_of_nothing_and_without_expand(spark):
    none = distinct.distinct_counts(distinct.id_bitmaps(frame(spark, []), ["a", "b"]), NAMES).first()
    assert none.asDict() == {"total_records": 0, "distinct_a": 0, "distinct_b": 0}
    bronze = fixtures.bronze_events(spark, SF_DIR)
    assert "Expand" in plan(quality.events_overview(bronze))
    bitmaps = distinct.id_bitmaps(bronze, ["visitorid", "itemid"])
    assert "Expand" not in plan(distinct.distinct_counts(bitmaps, {"visitorid": "v", "itemid": "i"}))


def test_completeness_from_footers_reads_no_rows(spark, tmp_path):
    bronze = fixtures.bronze_item_properties(spark, SF_DIR)
    gaps = bronze.withColumn("timestamp", F.when(F.col("itemid") % 3 > 0, F.col("timestamp")))
    write_table(gaps, str(tmp_path / "bronze"))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = quality.stored_completeness(spark, str(tmp_path / "bronze"))
    assert got.collect() == quality.completeness(gaps).collect()
    assert "PushedAggregation: [COUNT(*), COUNT(timestamp)" in plan(got)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
