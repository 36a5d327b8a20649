import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import START_MS, bronze_properties, tuples
from tidemark.functions import validation
from tidemark.operators import properties as props
from tidemark.schemas import EVENT_CSV, PROPERTY_CSV
from tidemark.session import recommended_conf, workspace
from tidemark.sinks import batches, tables
from tidemark.sources import messages
from tidemark.sources.files import read_csv, stream_csv


@pytest.fixture
def home(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def land(folder, name, text, day="2024/01/31"):
    path = f"{folder}/{day}"
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as file:
        file.write(text)


BAD_CSV = """timestamp,itemid,property,value
1,1,1,a
2,2,available,b
3,3
4,4,4,d,extra
5,5,5,
"""


def test_csv_cells_that_do_not_parse_become_null(spark, home):
    land(home, "a.csv", BAD_CSV)
    rows = read_csv(spark, home, PROPERTY_CSV)
    assert tuples(rows, *rows.columns) == [
        (1, 1, 1, "a"),
        (2, 2, None, "b"),
        (3, 3, None, None),
        (4, 4, 4, "d"),
        (5, 5, 5, None),
    ]
    checked = validation.with_status(rows, validation.property_error())
    assert validation.failed(checked).count() == 2


def test_malformed_lines_can_be_kept(spark, home):
    land(home, "a.csv", BAD_CSV)
    rows = read_csv(spark, home, PROPERTY_CSV, corrupt_column="_bad")
    kept = [row[-1] for row in tuples(rows, *rows.columns) if row[-1]]
    assert sorted(kept) == ["2,2,available,b", "3,3", "4,4,4,d,extra"]


def test_schema_is_inferred_without_one(spark, home):
    land(home, "a.csv", "timestamp,itemid\n1700000000000,12\n")
    types = dict(read_csv(spark, home).dtypes)
    assert types == {"timestamp": "bigint", "itemid": "int"}
    assert dict(stream_csv(spark, home).dtypes) == types


def test_incremental_ingest_reads_nested_files_once(spark, home):
    landing, target = f"{home}/landing", f"{home}/bronze"

    def ingest():
        rows = props.with_ingestion_metadata(stream_csv(spark, landing, PROPERTY_CSV), "load")
        tables.append_stream(rows, target, f"{home}/c")

    land(landing, "a.csv", "timestamp,itemid,property,value\n1,1,1,a\n")
    ingest()
    land(landing, "b.csv", "timestamp,itemid,property,value\n2,2,2,b\n", day="2024/02/01")
    ingest()
    ingest()
    bronze = tables.read_table(spark, target)
    assert tuples(bronze, "timestamp", "value", "_load_id") == [(1, "a", "load"), (2, "b", "load")]
    files = [os.path.basename(f) for (f,) in tuples(bronze, "_source_file")]
    assert sorted(files) == ["a.csv", "b.csv"]


def test_published_log_feeds_the_message_stream(spark, home):
    landing, log = f"{home}/landing", f"{home}/messages"
    land(landing, "a.csv", "timestamp,visitorid,event,itemid,transactionid\n5,v,view,1,\nx,v,view,1,\n")

    def publish():
        rows = stream_csv(spark, landing, EVENT_CSV).select(
            "*", F.col("_metadata.file_path").alias("_source_file")
        )
        messages.publish_events(rows, log, f"{home}/c")

    publish()
    publish()
    sent = messages.message_stream(spark, log)
    tables.append_stream(sent, f"{home}/read", f"{home}/c2")
    got = tables.read_table(spark, f"{home}/read")
    assert tuples(got, "partitionKey") == [("1",)]
    assert tuples(messages.rejected_messages(spark, log), "validation_error") == [
        ("invalid_timestamp",)
    ]


def test_partitioned_overwrite_replaces_everything_and_prunes(spark, home):
    rows = [(START_MS + i * 86_400_000, i, 1, "v") for i in range(6)]
    silver = props.silver_item_properties(bronze_properties(spark, rows))
    by = ("event_year", "event_month", "event_date")
    for _ in range(2):
        assert tables.write_table(silver, home, partition_by=by) == 6
    read = tables.read_table(spark, home)
    assert read.count() == 6
    plan = read.filter("event_date = date'2023-11-15'")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert glob.glob(f"{home}/event_year=2023/event_month=11/event_date=2023-11-15/*.parquet")


def test_appends_by_date_and_per_batch_callback(spark, home):
    rows = spark.range(4).select("id", F.lit("2024-01-01").cast("date").alias("event_date"))
    tables.write_table(rows, f"{home}/a", mode="append", partition_by=["event_date"])
    tables.write_table(rows, f"{home}/a", mode="append", partition_by=["event_date"])
    assert tables.read_table(spark, f"{home}/a").count() == 8
    stream = tables.stream_table(spark, f"{home}/a", max_files=1)
    for _ in range(2):
        enrich = batches.to_batches(
            f"{home}/b", lambda batch: batch.withColumn("_ingestion_time", F.current_timestamp())
        )
        batches.feed(stream, f"{home}/c", [enrich])
    assert batches.read_batches(spark, f"{home}/b").count() == 8


def test_wider_appends_are_read_with_merged_schema(spark, home):
    tables.write_table(spark.range(2), home, mode="append")
    tables.write_table(spark.range(1).withColumn("more", F.lit("x")), home, mode="append")
    merged = tables.read_table(spark, home, merge_schema=True)
    assert tuples(merged, "id", "more") == [(0, None), (0, "x"), (1, None)]


def test_catalog_appends_widen_the_table(spark, home):
    name = f"wide_{uuid.uuid4().hex}"
    tables.write_table(spark.range(2), name, mode="append")
    tables.write_table(spark.range(1).withColumn("more", F.lit("x")), name, mode="append")
    tables.write_table(spark.range(5, 6), name, mode="append")
    got = tuples(tables.read_table(spark, name), "id", "more")
    assert got == [(0, None), (0, "x"), (1, None), (5, None)]


def test_catalog_tables(spark, home):
    name = f"bronze_{uuid.uuid4().hex}"
    assert tables.write_table(spark.range(3), name) == 3
    copy = f"{name}_copy"
    tables.append_stream(tables.stream_table(spark, name), copy, f"{home}/c")
    tables.write_table(spark.range(2), name, mode="append")
    tables.append_stream(tables.stream_table(spark, name), copy, f"{home}/c")
    assert tables.read_table(spark, copy).count() == 5
    assert tables.write_table(spark.range(1), name) == 1
    assert tables.read_table(spark, name).count() == 1


def test_workspace_is_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one.startswith(base) and one != two


def test_recommended_settings_grow_with_the_input():
    small = recommended_conf(10**9, 8)
    large = recommended_conf(10**14, 4000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert int(small[key]) < int(large[key])
    assert 10**9 / int(small[key]) <= 256 * 1024 * 1024
    assert int(large[key]) <= 50_000
