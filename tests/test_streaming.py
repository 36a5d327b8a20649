"""Streams against their batch twins, with restarts, replays and late rows."""

import datetime as dt
import glob
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from tests.helpers import START_MS, bronze_events, tuples
from tidemark.operators import events as ev
from tidemark.operators import windows
from tidemark.sinks import batches
from tidemark.sinks.tables import append_stream, read_table, write_table
from tidemark.streaming import gold


@pytest.fixture
def home(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def drop(frame, folder):
    """Adds one file to a landing folder."""
    frame.coalesce(1).write.mode("append").parquet(folder)


def partition_filters(frame):
    """The partition filters of each scan of a plan."""
    plan = frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"PartitionFilters: (\[.*\])", plan)


def random_events(spark, n=240, seed=3):
    rng = random.Random(seed)
    rows = [
        (
            str(START_MS + rng.randint(0, 4_000_000)),
            str(rng.randint(1, 5)),
            rng.choice(["view", "addtocart", "transaction"]),
            str(rng.randint(1, 4)),
            f"t{rng.randint(1, 30)}",
        )
        for _ in range(n)
    ]
    return bronze_events(spark, rows)


def stream(spark, folder):
    schema = spark.read.parquet(folder).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def landed(spark, home, files, bronze=None):
    bronze = random_events(spark) if bronze is None else bronze
    parts = [
        bronze.filter(F.abs(F.hash("_ingestion_id")) % files == part) for part in range(files)
    ]
    for part in parts:
        drop(part, f"{home}/landing")
    return bronze


@pytest.mark.parametrize("files", [1, 5])
def test_journey_stream_equals_batch(spark, home, files):
    silver = ev.silver_events(landed(spark, home, files))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    gold.stream_customer_journey(events, f"{home}/j", f"{home}/c")
    got = gold.read_journeys(spark, f"{home}/j")
    columns = [*silver.columns, "event_order"]
    assert tuples(got, *columns) == tuples(ev.customer_journey(silver), *columns)


@pytest.mark.parametrize("missing", [False, True])
def test_basket_stream_equals_batch(spark, home, missing):
    bronze = random_events(spark)
    if missing:
        bronze = bronze.withColumn("transactionid", F.lit(None).cast("string"))
    silver = ev.silver_events(landed(spark, home, 4, bronze))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    gold.stream_item_cooccurrence(events, f"{home}/b", f"{home}/c")
    columns = ["transactionid", "items_bought_together"]
    want = tuples(ev.item_cooccurrence(silver), *columns)
    assert tuples(gold.read_baskets(spark, f"{home}/b"), *columns) == want


def test_a_batch_writes_its_own_rows_only(spark, home):
    silver = ev.silver_events(landed(spark, home, 4))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    query = gold.stream_customer_journey(events, f"{home}/j", f"{home}/c")
    read = [p.numInputRows for p in query.recentProgress if p.numInputRows]
    written = batches.read_batches(spark, f"{home}/j/log").groupBy("batch_id").count()
    assert len(read) == 4 and written.count() == 4
    assert sum(row["count"] for row in written.collect()) == silver.count()


def test_a_new_checkpoint_keeps_the_earlier_rows(spark, home):
    def events(*names):
        return bronze_events(spark, [(str(START_MS), name, "view", "1", None) for name in names])

    drop(events("a", "b"), f"{home}/landing")
    rows = ev.silver_events(stream(spark, f"{home}/landing"))
    gold.stream_customer_journey(rows, f"{home}/j", f"{home}/c1")
    drop(events("c"), f"{home}/later")
    rows = ev.silver_events(stream(spark, f"{home}/later"))
    for _ in range(2):
        gold.stream_customer_journey(rows, f"{home}/j", f"{home}/c2")
    assert tuples(gold.read_journeys(spark, f"{home}/j"), "visitorid") == [("a",), ("b",), ("c",)]


def test_profiles_add_up_over_batches_and_streams(spark, home):
    rounds = (["a", "b"], ["b", "c"], ["a", "d"], ["e"], ["a"], ["e", "f"], ["b"])
    for round_, names in enumerate(rounds):
        rows = [(str(START_MS + round_), name, "view", "1", None) for name in names]
        drop(bronze_events(spark, rows), f"{home}/landing")
        events = ev.silver_events(stream(spark, f"{home}/landing"))
        gold.stream_visitor_profile(events, f"{home}/p", f"{home}/c")
        seen = sum(map(list, rounds[: round_ + 1]), [])
        want = sorted({name: seen.count(name) for name in seen}.items())
        profiles = gold.read_profiles(spark, f"{home}/p")
        assert tuples(profiles, "visitorid", "total_viewcount") == want
        assert tuples(profiles, "unique_items_viewed") == [(1,)] * len(want)
    drop(bronze_events(spark, [(str(START_MS), "a", "view", "2", None)]), f"{home}/other")
    gold.stream_visitor_profile(
        ev.silver_events(stream(spark, f"{home}/other")), f"{home}/p", f"{home}/c2"
    )
    profiles = gold.read_profiles(spark, f"{home}/p").filter("visitorid = 'a'")
    assert tuples(profiles, "total_viewcount", "unique_items_viewed") == [(4, 2)]


def test_sums_read_one_partition_per_bit(spark, home):
    def merge(parts):
        return parts.groupBy("k").agg(F.sum("n").alias("n"))

    for batch_id in range(13):
        parts = spark.createDataFrame([("all", 1), (f"k{batch_id % 3}", 1)], "k string, n bigint")
        if batch_id == 9:
            parts = parts.limit(0)
        batches.add_batch(parts, f"{home}/s", "one", batch_id, merge)
        if batch_id in (5, 7, 11):  # a replay
            batches.add_batch(parts, f"{home}/s", "one", batch_id, merge)
        total = batches.read_sums(spark, f"{home}/s", merge).filter("k = 'all'").first().n
        assert total == batch_id + 1 - (batch_id >= 9)
    (filters,) = partition_filters(batches.read_sums(spark, f"{home}/s", merge))
    assert re.search(r"batch_id#\d+L? IN \(13,12,8\)", filters)
    assert batches.covering(13) == [13, 12, 8] and batches.merged_into(8) == [7, 6, 4]


def test_a_failed_batch_leaves_the_earlier_one(spark, home):
    rows = spark.createDataFrame([("a", 1)], "k string, n int")
    batches.write_batch(rows, f"{home}/v", "one", 0)
    broken = rows.withColumn("n", F.raise_error(F.lit("broken")).cast("int"))
    for batch_id in (0, 1):
        with pytest.raises(Exception, match="broken"):
            batches.write_batch(broken, f"{home}/v", "one", batch_id)
    assert tuples(batches.read_batches(spark, f"{home}/v"), "k", "n") == [("a", 1)]


def test_late_events_shift_journeys_and_touch_their_windows_only(spark, home):
    day, minute = gold.DAY_MS, 60_000
    base = START_MS // day * day

    def events(*times):
        return bronze_events(spark, [(str(base + t), "v", "view", "i", str(t)) for t in times])

    drop(events(0, minute, day, day + 1, 3 * day), f"{home}/landing")
    def run():
        rows = ev.silver_events(stream(spark, f"{home}/landing"))
        gold.stream_customer_journey(rows, f"{home}/j", f"{home}/cj")
        gold.stream_sums(rows, gold.POPULARITY, f"{home}/w", f"{home}/cw")
    run()
    one_day = dt.date(1970, 1, 1) + dt.timedelta(days=base // day + 1)
    asked = gold.read_journeys(spark, f"{home}/j", one_day, one_day, ["v"])
    assert tuples(asked, "event_order") == [(3,), (4,)]
    log = [text for text in partition_filters(asked) if "journey_day" in text]
    assert log and all(f">= {one_day}" in text and f"<= {one_day}" in text for text in log)
    drop(events(30_000, 2 * day), f"{home}/landing")
    run()
    asked = gold.read_journeys(spark, f"{home}/j", one_day, one_day)
    assert tuples(asked, "event_order") == [(4,), (5,)]
    whole = ev.silver_events(spark.read.parquet(f"{home}/landing"))
    columns = [*whole.columns, "event_order"]
    assert tuples(gold.read_journeys(spark, f"{home}/j"), *columns) == tuples(
        ev.customer_journey(whole), *columns
    )
    want = windows.item_popularity(whole)
    assert tuples(gold.POPULARITY.read(spark, f"{home}/w"), *want.columns) == tuples(want, *want.columns)
    late = gold.POPULARITY.parts(ev.silver_events(events(30_000, 2 * day)))
    assert late.count() == 2


def test_journeys_of_events_without_a_time_and_without_keys(spark, home):
    rows = [("x", "v", "view", "i", "1"), (None, "v", "view", "i", "2"), (str(START_MS), None, "view", None, None),
            (str(START_MS), "v", "view", "i", None), (str(START_MS), None, "view", None, "3"), ("-1", "v", "view", "i", "4")]
    silver = ev.silver_events(landed(spark, home, 2, bronze_events(spark, rows)))
    gold.stream_customer_journey(ev.silver_events(stream(spark, f"{home}/landing")), f"{home}/j", f"{home}/c")
    columns = [*silver.columns, "event_order"]
    assert tuples(gold.read_journeys(spark, f"{home}/j"), *columns) == tuples(ev.customer_journey(silver), *columns)


def test_one_query_feeds_several_tables(spark, home):
    silver = ev.silver_events(landed(spark, home, 3))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    tables = {"m": gold.METRICS, "p": gold.POPULARITY, "b": gold.BEHAVIOR}
    query = batches.feed(events, f"{home}/c", [t.write(f"{home}/{n}") for n, t in tables.items()])
    assert sum(p.numInputRows for p in query.recentProgress) == 240
    for name, want in (("m", windows.event_metrics(silver)), ("p", windows.item_popularity(silver)),
                       ("b", windows.visitor_behavior(silver))):
        assert tuples(tables[name].read(spark, f"{home}/{name}"), *want.columns) == tuples(want, *want.columns)


@pytest.mark.parametrize("complete", [True, False])
def test_profile_stream_equals_batch(spark, home, complete):
    silver = ev.silver_events(landed(spark, home, 3))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    gold.stream_visitor_profile(events, f"{home}/p", f"{home}/c", complete)
    read = batches.read_newest if complete else gold.read_profiles
    columns = ["visitorid", "total_viewcount", "unique_items_viewed", "total_addtocart"]
    assert tuples(read(spark, f"{home}/p"), *columns) == tuples(
        ev.visitor_profile(silver), *columns
    )


@pytest.mark.parametrize(
    "measure,key", [(windows.event_metrics, "event"), (windows.item_popularity, "itemid")]
)
def test_window_streams_equal_batch(spark, home, measure, key):
    silver = ev.silver_events(landed(spark, home, 3))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    want = measure(silver)
    batches.update_stream(measure(events, watermark=None), f"{home}/u", f"{home}/cu")
    latest = batches.read_latest(spark, f"{home}/u", ["window_start", key])
    assert tuples(latest, *want.columns) == tuples(want, *want.columns)
    batches.replace_stream(measure(events, watermark=None), f"{home}/r", f"{home}/cr")
    newest = batches.read_newest(spark, f"{home}/r")
    assert tuples(newest, *want.columns) == tuples(want, *want.columns)


def test_watermark_closes_windows_and_drops_late_rows(spark, home):
    minute = 60_000
    base = 1_704_067_200_000

    def events(*minutes):
        return bronze_events(spark, [(str(base + m * minute), "1", "view", "a", None) for m in minutes])

    drop(events(1, 2, 7), f"{home}/landing")
    metrics = windows.event_metrics(
        ev.silver_events(stream(spark, f"{home}/landing"))
    )
    append_stream(metrics, f"{home}/m", f"{home}/c")
    drop(events(60), f"{home}/landing")
    append_stream(metrics, f"{home}/m", f"{home}/c")
    drop(events(3, 61), f"{home}/landing")
    append_stream(metrics, f"{home}/m", f"{home}/c")
    counts = tuples(read_table(spark, f"{home}/m").orderBy("window_start"), "event_count")
    assert counts == [(1,), (2,)]


def test_restart_processes_only_new_files(spark, home):
    bronze = random_events(spark)
    first, second = bronze.filter("visitorid < 3"), bronze.filter("visitorid >= 3")
    drop(first, f"{home}/landing")

    def run():
        events = ev.silver_events(stream(spark, f"{home}/landing"))
        gold.stream_customer_journey(events, f"{home}/j", f"{home}/c")
        append_stream(events, f"{home}/silver", f"{home}/cs")

    run()
    assert read_table(spark, f"{home}/silver").count() == ev.silver_events(first).count()
    run()
    assert read_table(spark, f"{home}/silver").count() == ev.silver_events(first).count()
    drop(second, f"{home}/landing")
    run()
    silver = ev.silver_events(bronze)
    columns = [*silver.columns, "event_order"]
    assert read_table(spark, f"{home}/silver").count() == silver.count()
    assert tuples(gold.read_journeys(spark, f"{home}/j"), *columns) == tuples(
        ev.customer_journey(silver), *columns
    )


def test_replayed_batch_changes_nothing(spark, home):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    rows = rows.withColumn("written_at", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp"))
    later = rows.withColumn("n", F.lit(9)).filter("k = 'a'")
    batches.write_batch(rows, f"{home}/v", "one", 0)
    batches.write_batch(later, f"{home}/v", "one", 1)
    before = tuples(batches.read_latest(spark, f"{home}/v", ["k"]), "k", "n")
    batches.write_batch(later, f"{home}/v", "one", 1)
    assert tuples(batches.read_latest(spark, f"{home}/v", ["k"]), "k", "n") == before == [("a", 9), ("b", 2)]


def test_behavior_stream_counts_distinct_items_approximately(spark, home):
    silver = ev.silver_events(landed(spark, home, 2))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    behavior = windows.visitor_behavior(events, watermark=None, approximate=True)
    batches.update_stream(behavior, f"{home}/u", f"{home}/c")
    got = batches.read_latest(spark, f"{home}/u", ["window_start", "visitorid"])
    want = windows.visitor_behavior(silver)
    exact = [c for c in want.columns if c != "unique_items"]
    assert tuples(got, *exact) == tuples(want, *exact)
    near = got.alias("g").join(want.alias("w"), ["window_start", "visitorid"])
    assert near.filter("abs(g.unique_items - w.unique_items) > 1").count() == 0


def test_recent_volume_reads_the_last_days_alone(spark, home):
    day = 86_400_000
    rows = [(str(START_MS + i * day // 4), "1", "view", "a", None) for i in range(40)]
    silver = ev.silver_events(landed(spark, home, 3, bronze_events(spark, rows)))
    events = ev.silver_events(stream(spark, f"{home}/landing"))
    gold.stream_sums(events, gold.METRICS, f"{home}/m", f"{home}/c")
    as_of = windows.last_window_end(silver)
    stored = gold.stored_window_end(spark, f"{home}/m")
    whole = windows.recent_event_volume(windows.event_metrics(silver), as_of)
    recent = gold.read_recent_volume(spark, f"{home}/m", stored)
    assert tuples(recent, *whole.columns) == tuples(whole, *whole.columns) == [("view", 1, 1)]
    assert any("window_date" in found and ">=" in found for found in partition_filters(recent))
    assert gold.read_recent_volume(spark, f"{home}/m").count() == 0


def test_recent_volume_at_midnight_and_without_events(spark, home):
    midnight = START_MS - START_MS % 86_400_000
    rows = [(str(midnight + step), "1", "view", "a", None) for step in (-3_600_000, -1, 0, 299_999)]
    silver = ev.silver_events(bronze_events(spark, rows))
    as_of = windows.last_window_end(silver)
    metrics = windows.event_metrics(windows.recent_events(silver, as_of))
    assert tuples(windows.recent_event_volume(metrics, as_of), "windows", "event_count") == [(2, 3)]
    none = silver.limit(0)
    metrics = windows.event_metrics(windows.recent_events(none, windows.last_window_end(none)))
    assert windows.recent_event_volume(metrics, windows.last_window_end(none)).count() == 0


EXACT = [
    (windows.event_metrics, windows.METRICS_WIDTH),
    (windows.visitor_behavior, windows.BEHAVIOR_WIDTH),
    (windows.item_popularity, windows.POPULARITY_WIDTH),
]


def keep(spark, home, rows, measure, width):
    """Appends rows to the stored log and brings its windows up to date."""
    dated = gold.dated(ev.silver_events(rows))
    write_table(dated, f"{home}/silver", mode="append", partition_by=[gold.EVENT_DATE])
    return gold.stream_exact_windows(
        spark, f"{home}/silver", f"{home}/w", f"{home}/c", measure, width, dated.schema
    )


@pytest.mark.parametrize("measure,width", EXACT)
def test_late_rows_correct_the_windows_they_touch(spark, home, measure, width):
    day = 86_400_000
    first = [
        (str(START_MS + d * day + s * 400_000), str(s % 3), "view", str(s % 4), None)
        for d in range(3) for s in range(12)
    ] + [("x", "1", "view", "1", None), (None, "1", "view", "1", None)]
    late = [(str(START_MS + day + 7), "0", "transaction", "9", "t"), (str(START_MS + day), "7", "view", None, None)]
    keep(spark, home, bronze_events(spark, first), measure, width)
    before = sorted(glob.glob(f"{home}/w/*/*.parquet"))
    keep(spark, home, bronze_events(spark, late), measure, width)
    after = sorted(glob.glob(f"{home}/w/*/*.parquet"))
    whole = measure(ev.silver_events(bronze_events(spark, first + late)))
    assert tuples(gold.read_windows(spark, f"{home}/w"), *whole.columns) == tuples(whole, *whole.columns)
    folders = lambda files: {file.split("/")[-2] for file in files}
    assert folders(set(before) ^ set(after)) == {"window_date=2023-11-15"}
    touched = windows.touched_windows(ev.silver_events(bronze_events(spark, late)), width)
    assert touched.count() == 1
    keep(spark, home, bronze_events(spark, late[:1]).limit(0), measure, width)
    assert sorted(glob.glob(f"{home}/w/*/*.parquet")) == after


def test_touched_windows_replayed_change_nothing(spark, home):
    measure, width = EXACT[1]
    rows = random_events(spark)
    keep(spark, home, rows, measure, width)
    source = f"{home}/silver"
    write = gold.windows_write(lambda: read_table(spark, source), f"{home}/w", measure, width)
    for _ in range(2):
        write(ev.silver_events(rows.limit(5)), "s", 0)
    whole = measure(ev.silver_events(rows))
    assert tuples(gold.read_windows(spark, f"{home}/w"), *whole.columns) == tuples(whole, *whole.columns)
