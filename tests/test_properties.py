import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.helpers import DAY_MS, START_MS, bronze_properties, tuples
from tidemark.operators import properties as props
from tidemark.operators import quality

ROWS = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(START_MS, START_MS + 3)),
        st.one_of(st.none(), st.integers(1, 3)),
        st.one_of(st.none(), st.integers(1, 2)),
        st.sampled_from(["a", "b", None]),
    ),
    max_size=30,
)


def test_latest_row_wins_and_ties_are_settled_by_value(spark):
    bronze = bronze_properties(
        spark,
        [
            (START_MS, 1, 1, "old"),
            (START_MS + 5, 1, 1, "a"),
            (START_MS + 5, 1, 1, "b"),
            (None, 1, 2, "undated"),
            (START_MS, 1, 2, "dated"),
            (None, 2, 1, "alone"),
            (START_MS, None, 1, "no item"),
            (START_MS, 1, None, "no property"),
        ],
    )
    silver = props.silver_item_properties(bronze)
    assert tuples(silver, "item_id", "property_id", "property_value") == [
        (1, 1, "b"),
        (1, 2, "dated"),
        (2, 1, "alone"),
    ]


def test_required_columns_are_a_parameter(spark):
    bronze = bronze_properties(spark, [(None, 1, 1, "x"), (START_MS, 1, None, "y")])
    silver = props.silver_item_properties(bronze, required=("timestamp_unix", "item_id"))
    assert tuples(silver, "property_id", "property_value") == [(None, "y")]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=ROWS)
def test_silver_holds_the_newest_row_of_each_key(spark, rows):
    silver = props.silver_item_properties(bronze_properties(spark, rows))
    got = {
        (r.item_id, r.property_id): r.timestamp_unix
        for r in silver.collect()
    }
    want = {}
    for ts, item, prop, _ in rows:
        if item is not None and prop is not None:
            seen = want.get((item, prop))
            want[item, prop] = max((t for t in (seen, ts) if t is not None), default=None)
    assert got == want
    ratio = quality.dedup_ratio(bronze_properties(spark, rows)).first()
    assert (ratio.input_rows, ratio.output_rows) == (len(rows), len(want))
    assert ratio.dedup_ratio == (len(rows) / len(want) if want else None)


def test_summary_and_days_active_across_midnight(spark):
    midnight = 1_704_067_200_000
    bronze = bronze_properties(
        spark, [(midnight - 1000, 7, 1, "a"), (midnight + 1000, 7, 2, "b"), (midnight, 8, 1, "c")]
    )
    summary = props.item_property_summary(props.silver_item_properties(bronze))
    assert tuples(
        summary, "item_id", "property_count", "total_values", "property_ids", "days_active"
    ) == [(7, 2, 2, [1, 2], 1), (8, 1, 1, [1], 0)]


def test_frequency_ratio_sums_to_one(spark):
    bronze = bronze_properties(
        spark, [(START_MS + i, i, i % 3, str(i % 2)) for i in range(20)]
    )
    statistics = props.property_statistics(props.silver_item_properties(bronze))
    total = statistics.agg(F.sum("frequency_ratio")).first()[0]
    assert abs(total - 1) < 0.001
    assert statistics.agg(F.sum("total_property_records")).first()[0] == 20


def test_lists_stay_aligned(spark):
    bronze = bronze_properties(
        spark, [(START_MS + DAY_MS * i, 1, 5 - i, f"v{5 - i}") for i in range(4)]
    )
    lists = props.item_property_lists(props.silver_item_properties(bronze)).first()
    assert lists.property_ids == [2, 3, 4, 5]
    assert lists.property_values == ["v2", "v3", "v4", "v5"]
    assert lists.last_updated == dt.date(2023, 11, 17)


def test_statistics_over_values(spark):
    bronze = bronze_properties(
        spark, [(START_MS, 1, 1, "x"), (START_MS, 2, 1, "x"), (START_MS, 3, 1, None)]
    )
    row = props.property_statistics(props.silver_item_properties(bronze)).first()
    assert (row.items_with_property, row.total_property_records, row.distinct_values) == (3, 3, 1)


def test_everything_accepts_empty_input(spark):
    bronze = bronze_properties(spark, [])
    silver = props.silver_item_properties(bronze)
    for empty in (
        silver,
        props.item_property_summary(silver),
        props.property_statistics(silver),
        props.top_enriched_items(silver),
        props.item_property_lists(silver),
        props.property_count_per_item(silver),
    ):
        assert empty.count() == 0
    assert quality.dedup_ratio(bronze).first().dedup_ratio is None
    assert quality.completeness(bronze).first().total_records == 0
    assert quality.silver_quality(silver).first().total_records == 0
    assert tuple(quality.null_key_check(silver).first()) == (0, 0)
