"""Tables that grow run by run: wider streams, silver by bucket, quarantined payloads, load counts."""

import glob
import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import START_MS, bronze_events, tuples
from tidemark.operators import events as ev
from tidemark.operators import properties as props
from tidemark.operators import quality
from tidemark.plans import batch_layer
from tidemark.schemas import EVENT_CSV, ITEM_BRONZE
from tidemark.sinks.tables import append_stream, read_table
from tidemark.sources import messages

SILVER = ["timestamp_unix", "event_time", "item_id", "property_id", "property_value", "event_date"]


@pytest.fixture
def home(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def drop(frame, folder):
    frame.coalesce(1).write.mode("append").parquet(folder)


def test_a_stream_widens_its_catalog_table_and_fills_what_it_lacks(spark, home):
    target = f"wide_{uuid.uuid4().hex}"

    def run(frame):
        drop(frame, f"{home}/landing")
        rows = spark.readStream.schema(frame.schema).parquet(f"{home}/landing")
        append_stream(rows, target, f"{home}/c")

    run(spark.range(1))
    run(spark.range(1, 2).withColumn("More", F.lit("x")))
    run(spark.range(2, 3))
    run(spark.range(3, 4).select(F.lit(1.5).alias("other"), "id"))
    assert read_table(spark, target).columns == ["id", "More", "other"]
    assert tuples(read_table(spark, target), "id", "more", "other") == [
        (0, None, None), (1, "x", None), (2, None, None), (3, None, 1.5),
    ]


def bronze(spark, rows, loaded):
    full = [(*row, None, f"f{loaded}", "l") for row in rows]
    frame = spark.createDataFrame(full, ITEM_BRONZE)
    return frame.withColumn("_ingestion_time", F.timestamp_seconds(F.lit(loaded)))


def bucket_files(path):
    return {
        bucket: sorted(glob.glob(f"{bucket}/*.parquet"))
        for bucket in glob.glob(f"{path}/{batch_layer.BUCKET}=*")
    }


def test_a_second_drop_of_one_item_rewrites_one_bucket(spark, home):
    def refine():
        batch_layer.refine_new(spark, f"{home}/bronze", f"{home}/silver", f"{home}/c", buckets=8)

    first = [(START_MS + i, i % 40, i % 3, f"v{i}") for i in range(400)] + [(1, None, 1, "x"), (1, 1, None, "y")]
    drop(bronze(spark, first, 10), f"{home}/bronze")
    refine()
    before = bucket_files(f"{home}/silver")
    assert len(before) == 8
    late = [(START_MS + 999, 7, 1, "new"), (START_MS - 5, 7, 2, "old"), (None, 7, 0, "no time")]
    drop(bronze(spark, late, 20), f"{home}/bronze")
    refine()
    after = bucket_files(f"{home}/silver")
    assert [b for b in before if before[b] != after[b]] == [
        f"{home}/silver/{batch_layer.BUCKET}={spark.range(1).select(F.pmod(F.hash(F.lit(7)), F.lit(8))).first()[0]}"
    ]
    refine()
    assert bucket_files(f"{home}/silver") == after
    whole = props.silver_item_properties(spark.read.parquet(f"{home}/bronze"))
    assert tuples(read_table(spark, f"{home}/silver"), *SILVER) == tuples(whole, *SILVER)


def test_many_drops_equal_one_rebuild(spark, home):
    for load in range(4):
        rows = [(START_MS + (i * 37 + load * 11) % 50, i % 5, i % 2, f"{i * load % 7}") for i in range(30)]
        drop(bronze(spark, rows, load), f"{home}/bronze")
        batch_layer.refine_new(spark, f"{home}/bronze", f"{home}/silver", f"{home}/c", 4)
    whole = props.silver_item_properties(spark.read.parquet(f"{home}/bronze"))
    assert tuples(read_table(spark, f"{home}/silver"), *SILVER) == tuples(whole, *SILVER)


def test_a_failing_key_check_leaves_the_old_silver(spark, home, monkeypatch):
    drop(bronze(spark, [(START_MS, 1, 1, "a")], 1), f"{home}/bronze")
    assert batch_layer.refine(spark, f"{home}/bronze", f"{home}/silver") == 1
    batch_layer.refine_new(spark, f"{home}/bronze", f"{home}/buckets", f"{home}/c", 2)
    drop(bronze(spark, [(START_MS, None, 1, "b"), (START_MS, 2, 2, "c")], 2), f"{home}/bronze")
    typed = props.typed_item_properties
    monkeypatch.setattr(props, "typed_item_properties", lambda rows, required=(): typed(rows, ()))
    with pytest.raises(ValueError, match="null_item_id"):
        batch_layer.refine(spark, f"{home}/bronze", f"{home}/silver")
    with pytest.raises(Exception, match="NULL in item_id"):
        batch_layer.refine_new(spark, f"{home}/bronze", f"{home}/buckets", f"{home}/c", 2)
    for table in ("silver", "buckets"):
        assert tuples(read_table(spark, f"{home}/{table}"), "item_id", "property_value") == [(1, "a")]
    monkeypatch.undo()
    assert batch_layer.refine(spark, f"{home}/bronze", f"{home}/silver") == 2
    batch_layer.refine_new(spark, f"{home}/bronze", f"{home}/buckets", f"{home}/c", 2)
    assert read_table(spark, f"{home}/buckets").count() == 2


def test_present_keys_and_empty_tables_pass(spark):
    rows = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tuples(quality.with_keys_present(rows, ["k"]), "k", "v") == [(1, "a")]
    assert quality.with_keys_present(rows.limit(0), ["k"]).count() == 0


def test_payloads_that_do_not_parse_are_kept_raw(spark):
    whole = '{"timestamp": 1, "visitorid": "v", "event": "view", "itemid": "i"}'
    payloads = [whole, whole[:-9], "", "[]", "nonsense", None, "{}", '{"visitorid": "w", "new": 1}']
    data = spark.createDataFrame([(p,) for p in payloads], "p string").select(
        F.col("p").cast("binary").alias("data"), F.current_timestamp().alias("approximateArrivalTimestamp")
    )
    checked = ev.checked_bronze_events(data)
    failed = checked.filter("payload_status = 'failed'")
    assert {r.payload for r in failed.collect()} == {whole[:-9], "", "[]", "nonsense", None}
    assert checked.filter("payload_status = 'passed' AND payload IS NOT NULL").count() == 0
    passed = checked.filter("payload_status = 'passed'")
    assert tuples(passed, "visitorid") == [(None,), ("v",), ("w",)]
    assert ev.bronze_events(data).count() == len(payloads)


def test_counts_of_a_load_by_micro_batch(spark, home):
    rows = [(str(START_MS), "v" if i % 3 else None, "view", "i", None) for i in range(10)]
    frame = bronze_events(spark, rows).select(*EVENT_CSV.fieldNames(), F.lit("file").alias("_source_file"))
    for part in (frame.limit(4), frame.filter("visitorid IS NULL")):
        drop(part, f"{home}/landing")
    landed = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/landing")
    counts = messages.LoadCounts()
    query = messages.publish_events(landed, f"{home}/m", f"{home}/c", counts=counts)
    assert sorted(counts.batches.values()) == [(0, 4), (2, 2)]
    assert counts.totals(query) == {"successful": 2, "failed": 6}
    again = messages.LoadCounts()
    query = messages.publish_events(landed, f"{home}/m", f"{home}/c", counts=again)
    assert again.totals(query) == {"successful": 0, "failed": 0}
    assert messages.rejected_messages(spark, f"{home}/m").count() == 6


def test_documented_vocabulary_in_any_case(spark):
    rows = [(str(START_MS), "v", name, "i", None) for name in ("View", "view", "CLICK", "transaction", None)]
    kept = ev.silver_events_validated(bronze_events(spark, rows), ("view", "click"), any_case=True)
    assert tuples(kept, "event") == [("click",), ("view",), ("view",)]
    exact = ev.silver_events_validated(bronze_events(spark, rows), ("view", "click"))
    assert tuples(exact, "event") == [("view",)]


def shuffled_bytes(node):
    """Bytes of the rows that the exchanges of an executed plan were given."""
    kind = node.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return shuffled_bytes(node.executedPlan())
    if kind.endswith("QueryStageExec"):
        return shuffled_bytes(node.plan())
    size = node.metrics().apply("dataSize").value() if kind == "ShuffleExchangeExec" else 0
    return size + sum(shuffled_bytes(node.children().apply(i)) for i in range(node.children().size()))


def test_paths_are_not_sorted_with_the_rows(spark, tmp_path, monkeypatch):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")
    spark.range(6000).selectExpr(
        "if(id % 11 = 0, null, id % 5) AS timestamp", "cast(id % 1000 as int) AS itemid",
        "cast(id % 2 as int) AS property", "if(id % 7 = 0, null, string(id % 3)) AS value",
        "timestamp_seconds(id % 2) AS _ingestion_time", "'load' AS _load_id",
        "if(id % 13 = 0, null, concat('/landing/', repeat('x', 400), id % 17)) AS _source_file",
    ).write.parquet(bronze)
    kind, seen = type(spark.range(0)), []
    observe = kind.observe
    monkeypatch.setattr(kind, "observe", lambda self, *a: seen.append(self) or observe(self, *a))
    batch_layer.refine(spark, bronze, silver, ())
    got = {tuple(r) for r in seen[0].collect()}
    assert got == {tuple(r) for r in props.silver_item_properties(spark.read.parquet(bronze)).collect()}
    assert 0 < shuffled_bytes(seen[0]._jdf.queryExecution().executedPlan()) < 200 * 6000
