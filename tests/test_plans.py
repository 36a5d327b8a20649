"""Shapes of the physical plans, and the two layers end to end."""

import re
import uuid

import pytest

from tests.helpers import tuples
from tidemark.operators import events as ev
from tidemark.operators import properties as props
from tidemark.operators import windows
from tidemark.plans import batch_layer, fixtures, queries, speed_layer
from tidemark.schemas import EVENT_CSV, ITEM_SILVER
from tidemark.sinks.tables import read_table, write_table

SF_DIR = "/root/testdata/sf0.001"
STREAMS_OR_LANDS = {
    name
    for name in queries.all_queries()
    if name.endswith("_stream") or name.startswith(("batch_layer", "speed_layer"))
} | {"bronze_item_properties", "publish_events", "csv_inferred_preview", "schema_evolution_append"}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(queries.all_queries()) - STREAMS_OR_LANDS))
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(queries.all_queries()[name](spark, SF_DIR))
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Pandas"):
        assert node not in text


def test_deduplication_limits_each_key_before_the_shuffle(spark, tmp_path):
    write_table(fixtures.bronze_item_properties(spark, SF_DIR), str(tmp_path / "bronze"))
    text = plan(props.silver_item_properties(read_table(spark, str(tmp_path / "bronze"))))
    below = text[text.index("Exchange hashpartitioning") :]
    assert "row_number(), 1, Partial" in below
    assert text.count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(itemid), IsNotNull(property)]" in text


def test_scans_read_only_needed_columns(spark):
    text = plan(ev.events_by_type(fixtures.bronze_events(spark, SF_DIR)))
    assert "ReadSchema: struct<event_type:string>" in text


def test_top_k_does_not_sort_everything(spark):
    text = plan(ev.top_by_events(fixtures.silver_events(spark, SF_DIR), "itemid"))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def exchanges(frame):
    return len(re.findall(r"[-+] (?:Broadcast)?Exchange ", plan(frame)))


def test_grouped_operators_shuffle_little(spark, tmp_path):
    properties = props.silver_item_properties(fixtures.bronze_item_properties(spark, SF_DIR))
    write_table(properties, str(tmp_path / "silver"))
    silver = read_table(spark, str(tmp_path / "silver"))
    events = fixtures.silver_events(spark, SF_DIR)
    for limit, frame in [
        (1, props.item_property_summary(silver)),
        (1, props.item_property_lists(silver)),
        (1, props.top_enriched_items(silver)),
        (2, ev.item_cooccurrence(events)),
        (4, ev.customer_journey(events)),
    ]:
        assert 1 <= exchanges(frame) <= limit
        assert plan(frame).count("FileScan") <= 2
    assert plan(props.property_statistics(silver)).count("FileScan") == 1


def test_recent_volume_filters_events_before_grouping(spark, tmp_path):
    write_table(fixtures.silver_events(spark, SF_DIR), str(tmp_path / "silver"))
    events = read_table(spark, str(tmp_path / "silver"))
    as_of = windows.last_window_end(events)
    recent = windows.recent_events(events, as_of)
    text = plan(windows.recent_event_volume(windows.event_metrics(recent), as_of))
    assert "Window [" not in text and "SinglePartition" not in text.split("Subquery")[0]
    kept = recent.count()
    assert 0 < kept < events.count()


def test_visitor_lookup_numbers_that_visitor_alone(spark):
    silver = fixtures.silver_events(spark, SF_DIR)
    staged = spark.read.parquet(*ev.visitor_journey(silver, "7").inputFiles())
    assert {row.visitorid for row in staged.select("visitorid").collect()} == {"7"}


def test_batch_layer_on_catalog_tables(spark, tmp_path):
    home = str(tmp_path / "home")
    landing = fixtures.land_item_properties(spark, SF_DIR, f"{home}/landing")
    run = uuid.uuid4().hex
    names = [f"{layer}_{run}" for layer in ("bronze", "silver", "summary", "statistics")]
    months = ("event_year", "event_month")
    written = batch_layer.run(spark, landing, f"{home}/c", *names, partition_by=months)
    again = batch_layer.run(spark, landing, f"{home}/c", *names, partition_by=months)
    assert written == again
    assert written[names[1]] == read_table(spark, names[1]).count()
    silver = fixtures.silver_item_properties(spark, SF_DIR)
    columns = ["item_id", "property_count", "property_ids", "days_active"]
    assert tuples(read_table(spark, names[2]), *columns) == tuples(
        props.item_property_summary(silver), *columns
    )


def test_batch_layer_on_a_file_without_rows(spark, tmp_path):
    home = str(tmp_path / "home")
    (tmp_path / "home" / "landing").mkdir(parents=True)
    (tmp_path / "home" / "landing" / "a.csv").write_text("timestamp,itemid,property,value\n")
    tables = [f"{home}/{name}" for name in ("bronze", "silver", "summary", "statistics")]
    written = batch_layer.run(spark, f"{home}/landing", f"{home}/c", *tables)
    assert set(written.values()) == {0}
    silver = read_table(spark, tables[1], schema=ITEM_SILVER)
    assert silver.count() == 0
    assert set(silver.columns) == set(props.silver_item_properties(
        read_table(spark, tables[0])
    ).columns)


def test_speed_layer_on_a_file_without_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("timestamp,visitorid,event,itemid,transactionid\n")
    gold = speed_layer.run(spark, str(landing), str(tmp_path / "tables"))
    assert {name: frame.count() for name, frame in gold.items()} == dict.fromkeys(gold, 0)


def test_speed_layer_in_two_drops(spark, tmp_path):
    home = str(tmp_path / "home")
    rows = fixtures.bronze_events(spark, SF_DIR).select(*EVENT_CSV.fieldNames())
    early = rows.filter("timestamp < '1705000000000'")
    late = rows.filter("timestamp >= '1705000000000'")
    for part in (late, early):
        part.write.mode("append").option("header", True).csv(f"{home}/landing/2024/01/31")
        gold = speed_layer.run(spark, f"{home}/landing", f"{home}/tables")
    silver = ev.silver_events(rows)
    journey = ["visitorid", "itemid", "timestamp", "event", "event_order"]
    assert tuples(gold["customer_journey"], *journey) == tuples(
        ev.customer_journey(silver), *journey
    )
    baskets = ["transactionid", "items_bought_together"]
    assert tuples(gold["item_cooccurrence"], *baskets) == tuples(
        ev.item_cooccurrence(silver), *baskets
    )
    profile = ["visitorid", "total_viewcount", "total_addtocart", "bought_something"]
    assert tuples(gold["visitor_profile"], *profile) == tuples(
        ev.visitor_profile(silver), *profile
    )
