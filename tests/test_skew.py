"""Groups that hold much of the data, against plain Python, under one plan."""

import random
from collections import Counter

import pytest

from tests.helpers import START_MS, bronze_events, bronze_properties, tuples
from tidemark.operators import events as ev
from tidemark.operators import properties as props


def skewed_events(spark, n=600):
    """A third of the rows in one visitor, item and transaction, many at one instant."""
    rng = random.Random(7)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        visitor = "hot" if hot else rng.choice(["a", "b", None])
        item = "1" if hot else str(rng.randint(1, 5))
        transaction = None if hot else f"t{rng.randint(1, 40)}"
        dated = START_MS + rng.randint(0, 9) * 60_000 + rng.randint(0, 40)
        when = rng.choice([None, "bad", *[str(dated)] * 30])
        event = rng.choice(["view", "transaction", "transaction"])
        rows.append((when, visitor, event, item, transaction))
    return ev.silver_events(bronze_events(spark, rows)).cache()


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_numbers_do_not_depend_on_the_ranges(spark, partitions):
    events = skewed_events(spark)
    rows = [row.asDict() for row in events.collect()]

    def place(row):
        bad = row["timestamp"] in (None, "bad")
        ties = [(row[c] is not None, row[c] or "") for c in ("event", "transactionid")]
        return (0 if bad else int(row["timestamp"]), ties, row["_ingestion_id"])

    want, seen = {}, Counter()
    for row in sorted(rows, key=place):
        seen[row["visitorid"], row["itemid"]] += 1
        want[row["_ingestion_id"]] = seen[row["visitorid"], row["itemid"]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # Few rows, so AQE would merge all ranges into one.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ev.customer_journey(events).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {row["_ingestion_id"]: row.event_order for row in got} == want
    assert len(got) == len(rows)


def test_baskets_hold_every_item(spark):
    events = skewed_events(spark)
    want = {}
    for transaction, item in tuples(ev.purchases(events), "transactionid", "itemid"):
        want.setdefault(transaction, []).append(item)
    got = ev.item_cooccurrence(events).collect()
    assert {row.transactionid: row.items_bought_together for row in got} == {
        key: sorted(items) for key, items in want.items()
    }
    assert len(got) == len(want)


def test_a_basket_of_missing_items_is_kept(spark):
    rows = [("1", "v", "transaction", None, "t")] * 9
    baskets = ev.item_cooccurrence(ev.silver_events(bronze_events(spark, rows)))
    assert tuples(baskets, "transactionid", "items_bought_together") == [("t", [])]


def test_both_lookups_find_a_large_basket_whole(spark):
    numbers = spark.range(100_000).selectExpr(
        "'1' AS timestamp", "'v' AS visitorid", "'transaction' AS event",
        "CAST(id % 50000 AS STRING) AS itemid", "CAST(NULL AS STRING) AS transactionid",
    )
    events = numbers.union(numbers.limit(5).selectExpr("* EXCEPT (transactionid)", "'t' AS transactionid"))
    items = ev.basket_items(ev.purchases(events))
    for item, keys in (("49999", {None}), ("3", {None, "t"})):
        stored = ev.baskets(ev.baskets_containing(items, item)).collect()
        again = ev.baskets_with_item(events, item).collect()
        assert sorted(map(str, stored)) == sorted(map(str, again))
        assert {row.transactionid for row in stored} == keys
        sizes = {row.transactionid: len(row.items_bought_together) for row in stored}
        assert sizes[None] == 100_000


def test_item_summary_and_lists_have_one_row_per_item(spark):
    rows = [(START_MS + i, 1, i, f"v{i}") for i in range(90)]
    rows += [(START_MS, item, 1, "x") for item in range(2, 20)]
    silver = props.silver_item_properties(bronze_properties(spark, rows)).cache()
    summary = {row.item_id: row for row in props.item_property_summary(silver).collect()}
    assert len(summary) == 19
    assert (summary[1].property_count, summary[1].total_values) == (90, 90)
    assert summary[1].property_ids == list(range(90))
    lists = props.item_property_lists(silver).filter("item_id = 1").collect()
    assert [list(zip(row.property_ids, row.property_values)) for row in lists] == [
        [(i, f"v{i}") for i in range(90)]
    ]


def test_repeated_properties_are_one_list_entry(spark):
    rows = [(1, p % 3, "2024-01-01 00:00:00") for p in range(30)] + [(2, None, None)]
    silver = spark.createDataFrame(rows, "item_id int, property_id int, t string")
    silver = silver.selectExpr("*", "CAST(t AS TIMESTAMP_NTZ) AS event_time")
    summary = props.item_property_summary(silver)
    assert tuples(summary, "item_id", "property_count", "total_values", "property_ids") == [
        (1, 3, 30, [0, 1, 2]),
        (2, 0, 1, []),
    ]
