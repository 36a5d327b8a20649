import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import START_MS, bronze_events, tuples
from tidemark.functions import clock, validation
from tidemark.operators import events as ev
from tidemark.operators import quality, windows
from tidemark.schemas import DOCUMENTED_EVENT_TYPES, EVENT_TYPES
from tidemark.sources import messages

T0 = str(START_MS)


def test_vocabulary_and_transaction_id(spark):
    bronze = bronze_events(
        spark,
        [
            (T0, "1", "view", "a", "t1"),
            (T0, "1", "transaction", "a", "t1"),
            (T0, "1", "transaction", "b", None),
            (T0, "1", "View", "a", None),
            (T0, "1", " view", "a", None),
            (T0, "1", None, "a", None),
            (T0, "1", "purchase", "a", "t2"),
        ],
    )
    silver = ev.silver_events(bronze)
    assert tuples(silver, "event", "itemid", "transactionid") == [
        ("transaction", "a", "t1"),
        ("transaction", "b", None),
        ("view", "a", None),
    ]
    documented = ev.silver_events(bronze, DOCUMENTED_EVENT_TYPES, purchase="purchase")
    assert ("purchase", "t2") in tuples(documented, "event", "transactionid")


def test_bad_timestamps_become_null_and_do_not_fail(spark):
    bronze = bronze_events(
        spark,
        [(t, "1", "view", "a", None) for t in ("x", "", "1.5", None, "9" * 18, "-1500", T0)],
    )
    silver = ev.silver_events(bronze)
    times = [t for (t,) in tuples(silver, "event_time") if t is not None]
    assert sorted(times) == [
        dt.datetime(1969, 12, 31, 23, 59, 59),
        dt.datetime(2023, 11, 14, 22, 13, 20),
    ]
    assert silver.count() == 7


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_session_time_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        silver = ev.silver_events(bronze_events(spark, [("1704067199999", "1", "view", "a", None)]))
        row = windows.event_metrics(silver).first()
        assert row.window_start == dt.datetime(2023, 12, 31, 23, 55)
        assert row.window_end == dt.datetime(2024, 1, 1)
        assert silver.first().event_time == dt.datetime(2023, 12, 31, 23, 59, 59)
        hour = silver.select(clock.hour_start("timestamp")).first()[0]
        assert hour == dt.datetime(2023, 12, 31, 23)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bad_json_survives_bronze_and_is_dropped_by_silver(spark):
    payloads = [
        '{"timestamp": 1700000000000, "visitorid": "1", "event": "view", "itemid": "a"}',
        '{"timestamp": 17',
        '{"event": "view", "more": {"x": 1}}',
        "null",
    ]
    frame = spark.createDataFrame([(p.encode(),) for p in payloads], "data binary")
    bronze = ev.bronze_events(
        frame.withColumn("approximateArrivalTimestamp", F.current_timestamp())
    )
    assert bronze.count() == 4
    assert tuples(bronze.filter("event is not null"), "timestamp", "event") == [
        (None, "view"),
        ("1700000000000", "view"),
    ]
    assert ev.silver_events(bronze).count() == 2
    assert ev.silver_events_validated(bronze).count() == 1


def test_published_messages_trim_and_quarantine(spark):
    rows = bronze_events(
        spark,
        [
            (" 5 ", " v ", "view", " a", " t"),
            ("x", "v", "view", "a", None),
            ("", "v", "view", "a", None),
            ("1.5", "v", "view", "a", None),
            ("1", " ", "view", "a", None),
            ("1", "v", None, "a", None),
            ("1", "v", "view", None, None),
        ],
    ).withColumn("_source_file", F.lit("f.csv"))
    sent = messages.to_messages(messages.event_records(rows, "load"))
    assert tuples(sent, "validation_status", "validation_error") == sorted(
        [
            ("passed", None),
            ("failed", "invalid_timestamp"),
            ("failed", "invalid_timestamp"),
            ("failed", "missing_timestamp"),
            ("failed", "missing_visitorid"),
            ("failed", "missing_event"),
            ("failed", "missing_itemid"),
        ],
        key=lambda row: tuple((v is not None, str(v)) for v in row),
    )
    good = sent.filter("validation_error is null").first()
    assert good.key == "a"
    assert '"timestamp":5,' in good.value and '"transactionid":"t"' in good.value
    ids = sent.select(F.get_json_object("value", "$._ingestion_id").alias("i")).dropna()
    assert ids.filter(F.col("i").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).count() == 1


def test_validation_report_counts_unknown_events(spark):
    bronze = bronze_events(spark, [(T0, "1", e, "a", None) for e in ("view", "signup", "error")])
    checked = validation.with_status(bronze, validation.event_error(EVENT_TYPES))
    report = tuples(quality.validation_report(checked), "validation_error", "record_count")
    assert report == [(None, 1), ("unknown_event", 2)]
    assert quality.validation_error_count(checked).first().errors == 2
    assert validation.passed(checked).count() == 1
    assert validation.failed(checked).count() == 2


def test_profile_journey_and_baskets(spark):
    t = [str(START_MS + i) for i in range(5)]
    silver = ev.silver_events(
        bronze_events(
            spark,
            [
                (t[1], "1", "view", "a", None),
                (t[0], "1", "view", "a", None),
                (t[0], "1", "addtocart", "a", None),
                (t[2], "1", "transaction", "a", "x"),
                (t[2], "1", "transaction", "a", "x"),
                (t[3], "1", "transaction", "b", "x"),
                (t[3], "2", "transaction", "c", None),
                (t[3], "2", "view", None, None),
            ],
        )
    )
    assert tuples(
        ev.visitor_profile(silver),
        "visitorid",
        "total_viewcount",
        "unique_items_viewed",
        "total_addtocart",
        "bought_something",
    ) == [("1", 2, 1, 1, 1), ("2", 1, 0, 0, 1)]
    journey = ev.visitor_journey(silver, "1").filter("itemid = 'a'")
    assert [(r.event, r.event_order) for r in journey.collect()] == [
        ("addtocart", 1),
        ("view", 2),
        ("view", 3),
        ("transaction", 4),
        ("transaction", 5),
    ]
    baskets = ev.item_cooccurrence(silver)
    assert tuples(baskets, "transactionid", "items_bought_together") == [
        (None, ["c"]),
        ("x", ["a", "a", "b"]),
    ]
    whole = [("x", ["a", "a", "b"])]
    assert tuples(ev.baskets_with_item(silver, "b"), "transactionid", "items_bought_together") == whole
    assert tuples(
        ev.baskets(ev.baskets_containing(ev.basket_items(ev.purchases(silver)), "b")),
        "transactionid",
        "items_bought_together",
    ) == whole


def test_recent_volume_uses_the_given_instant(spark):
    hour = 3_600_000
    base = 1_704_067_200_000
    silver = ev.silver_events(
        bronze_events(
            spark,
            [(str(base + i * hour // 2), "1", "view", "a", None) for i in range(6)],
        )
    )
    metrics = windows.event_metrics(silver)
    as_of = F.lit(dt.datetime(2024, 1, 1, 2, 0)).cast("timestamp_ntz")
    row = windows.recent_event_volume(metrics, as_of).first()
    assert (row.windows, row.event_count) == (4, 4)
    assert windows.recent_event_volume(metrics).count() == 0


def test_latency_and_rates(spark):
    bronze = bronze_events(spark, [(T0, "1", "view", "12", None), (T0, "1", "view", "x", None)])
    bronze = bronze.withColumn("_ingestion_timestamp", F.lit(str(START_MS + 1500)))
    latency = ev.with_latency(bronze)
    assert tuples(latency, "item_id", "ingestion_latency_seconds") == [(None, 1.5), (12, 1.5)]
    assert quality.data_freshness(bronze).first()[0] == START_MS + 1500
    day = quality.ingestion_rate_daily(bronze).first()
    assert (day.ingestion_date, day.record_count) == (dt.date(2023, 11, 14), 2)
    assert quality.ingestion_rate_hourly(bronze).first().ingestion_hour == dt.datetime(
        2023, 11, 14, 22
    )


def test_everything_accepts_empty_input(spark):
    bronze = bronze_events(spark, [])
    silver = ev.silver_events(bronze)
    for empty in (
        silver,
        ev.silver_events_validated(bronze),
        ev.visitor_profile(silver),
        ev.customer_journey(silver),
        ev.item_cooccurrence(silver),
        ev.baskets_with_item(silver, "a"),
        ev.event_timeline(silver),
        ev.top_by_events(silver, "itemid"),
        windows.event_metrics(silver),
        windows.visitor_behavior(silver),
        windows.trending_items(windows.item_popularity(silver)),
    ):
        assert empty.count() == 0
    assert quality.events_overview(bronze).first().total_events == 0
