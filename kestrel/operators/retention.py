"""First activity per user and monthly cohort retention.

"Active on or after first + offset" holds exactly when the user's latest
event date is on or after first + offset, so every offset is answered
from one per-user (min, max) aggregate instead of one self-join per
offset.  The per-user aggregate is combined map-side, so a user with a
huge share of the events costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# (output column, unit, amount): offsets of the cohort report
OFFSETS: tuple[tuple[str, str, int], ...] = (
    ("two_weeks_active", "day", 14),
    ("one_month_active", "month", 1),
    ("three_months_active", "month", 3),
)


def first_activity(events: DataFrame) -> DataFrame:
    """A3: user_id, first_active_date (a null user_id is a group of its own)."""
    return (events.groupBy("user_id")
                  .agg(F.min(F.to_date("event_time")).alias("first_active_date")))


def _shift(date_col: Column, unit: str, amount: int) -> Column:
    if unit == "day":
        return F.date_add(date_col, amount)
    if unit == "month":
        return F.add_months(date_col, amount)  # clamps to the month end
    raise ValueError(f"unit must be 'day' or 'month', got {unit!r}")


def user_span(events: DataFrame) -> DataFrame:
    """user_id, first_active_date, last_active_date."""
    d = F.to_date("event_time")
    return events.groupBy("user_id").agg(F.min(d).alias("first_active_date"),
                                         F.max(d).alias("last_active_date"))


def retention(events: DataFrame,
              offsets: Sequence[tuple[str, str, int]] = OFFSETS) -> DataFrame:
    """A4: per first-activity cohort (year, month): users started and users
    with any activity on or after first + each offset.

    Rows of the span are unique per user, so COUNT(user_id) under a
    condition equals COUNT(DISTINCT ...) and needs no Expand; a null user
    forms a cohort row but is not counted, as with COUNT(DISTINCT).
    """
    span = user_span(events)
    first, last = F.col("first_active_date"), F.col("last_active_date")
    aggs = [F.count("user_id").alias("total_started")]
    for name, unit, amount in offsets:
        aggs.append(F.count(F.when(last >= _shift(first, unit, amount), F.col("user_id")))
                    .alias(name))
    return (span.groupBy(F.year(first).cast("bigint").alias("first_year"),
                         F.month(first).cast("bigint").alias("first_month"))
                .agg(*aggs))


def order_retention(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("first_year").desc(), F.col("first_month").desc())
