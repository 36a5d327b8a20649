"""Per-row validation status and reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import clock

PASSED, FAILED = "passed", "failed"


def _blank(name: str) -> Column:
    return F.col(name).isNull() | (F.trim(name) == "")


def event_error(event_types: Sequence[str] | None = None) -> Column:
    """Reason why an event row is invalid, or NULL; the first failing rule names it."""
    rules = [
        (_blank("timestamp"), "missing_timestamp"),
        (clock.millis("timestamp").isNull(), "invalid_timestamp"),
        (_blank("visitorid"), "missing_visitorid"),
        (_blank("event"), "missing_event"),
    ]
    if event_types is not None:
        rules.append((~F.trim("event").isin(*event_types), "unknown_event"))
    rules.append((_blank("itemid"), "missing_itemid"))
    return F.coalesce(*[F.when(broken, F.lit(reason)) for broken, reason in rules])


def property_error() -> Column:
    """Reason why the silver layer drops an item-property row, or NULL."""
    return F.coalesce(
        F.when(F.col("itemid").isNull(), F.lit("missing_itemid")),
        F.when(F.col("property").isNull(), F.lit("missing_property")),
    )


def with_status(rows: DataFrame, error: Column) -> DataFrame:
    return rows.withColumn("validation_error", error).withColumn(
        "validation_status",
        F.when(F.col("validation_error").isNull(), PASSED).otherwise(FAILED),
    )


def passed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("validation_status") == PASSED).drop(
        "validation_status", "validation_error"
    )


def failed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("validation_status") == FAILED)
