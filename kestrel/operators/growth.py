"""Monthly active users per OS family and their month-on-month / year-on-year growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.growth import pct_growth
from kestrel.functions.rules import OS_RULES, Rule, classify_os


def monthly_active(events: DataFrame, devices: DataFrame,
                   rules: Sequence[Rule] = OS_RULES) -> DataFrame:
    """A1: distinct users per (activity_month, os).

    The single COUNT(DISTINCT) is planned as a dedup on (month, os,
    user_id) followed by a count: the first exchange is keyed by the user
    as well, so one large OS family is spread over all reducers.
    """
    ev = events.select("user_id", "device_id", "event_time")
    dv = devices.select("device_id", "os_type")
    j = ev.join(dv, "device_id", "inner")
    return (j.groupBy(F.trunc(F.to_date("event_time"), "month").alias("activity_month"),
                      classify_os("os_type", rules).alias("os"))
             .agg(F.countDistinct("user_id").alias("monthly_users_active")))


def growth(monthly: DataFrame, lags: tuple[int, int] = (1, 12), densify: bool = False) -> DataFrame:
    """A2: prior month / prior year users by row lag, null-safe growth.

    Lags count rows in month order within an OS (a missing month shifts
    them, as in the reference); ``densify=True`` first fills missing
    months with zero users so the lags are calendar lags.  The window's
    partitions hold one row per month, so they stay small however large
    the event table is.
    """
    m = monthly.select("activity_month", "os", "monthly_users_active")
    if densify:
        m = _densify_months(m)
    w = Window.partitionBy("os").orderBy(F.col("activity_month").asc_nulls_last())
    month_lag, year_lag = lags
    m = (m.withColumn("prior_month_users", F.lag("monthly_users_active", month_lag).over(w))
          .withColumn("prior_year_users", F.lag("monthly_users_active", year_lag).over(w)))
    return m.select(
        F.year("activity_month").cast("bigint").alias("activity_year"),
        F.month("activity_month").cast("bigint").alias("activity_month"),
        "os", "monthly_users_active", "prior_month_users", "prior_year_users",
        pct_growth("monthly_users_active", "prior_month_users").alias("mom_growth_percentage"),
        pct_growth("monthly_users_active", "prior_year_users").alias("yoy_growth_percentage"),
    )


def _densify_months(m: DataFrame) -> DataFrame:
    bounds = m.groupBy("os").agg(F.min("activity_month").alias("lo"),
                                 F.max("activity_month").alias("hi"))
    spine = bounds.select("os", F.explode(F.sequence("lo", "hi", F.expr("interval 1 month")))
                          .alias("activity_month"))
    return (spine.join(m, ["os", "activity_month"], "left")
                 .select("activity_month", "os",
                         F.coalesce("monthly_users_active", F.lit(0)).alias("monthly_users_active")))


def order_growth(report: DataFrame) -> DataFrame:
    """Final report order: newest month first, then OS."""
    return report.orderBy(F.col("activity_year").desc(), F.col("activity_month").desc(), "os")
