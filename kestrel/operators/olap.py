"""Dimension mapping, grouping sets, rollups, cubes and the level-named cube.

Plan shape for every grouped report here: the events are first counted
at the full grain (a partial + final ``HashAggregate``, so a hot grain
is combined map-side), and only those grain rows go through ``Expand``
for the grouping sets, re-summed with ``sum``.  COUNT is additive, so
this equals grouping the raw rows, while ``Expand`` multiplies grain
rows instead of events.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.levels import agg_level
from kestrel.functions.rules import (DEVICE_RULES, HOST_RULES, OVERALL, Rule, fill_unknown,
                                     map_device, map_host)

DIMS = ("host", "browser_type", "device_type", "os_type")


def _ts(value: str | dt.date) -> Column:
    """A ``timestamp_ntz`` literal at midnight of a date (constant-folded)."""
    return F.lit(str(value)).cast("date").cast("timestamp_ntz")


def between_dates(ts_col: str, start: str | dt.date, end: str | dt.date,
                  inclusive_last_day: bool = False) -> Column:
    """``ts BETWEEN DATE start AND DATE end`` on a timestamp.

    Literal form keeps only midnight of the last day; with
    ``inclusive_last_day`` the whole last day is kept.  Written as a range
    on the bare column so the parquet scan gets the pushed filter.
    """
    c = F.col(ts_col)
    lo = c >= _ts(start)
    if inclusive_last_day:
        return lo & (c < F.date_add(F.lit(str(end)).cast("date"), 1).cast("timestamp_ntz"))
    return lo & (c <= _ts(end))


def map_dims(events: DataFrame, devices: DataFrame, host_rules: Sequence[Rule] = HOST_RULES,
             device_rules: Sequence[Rule] = DEVICE_RULES, fill_browser: bool = True,
             start: str | dt.date | None = None, end: str | dt.date | None = None,
             inclusive_last_day: bool = False) -> DataFrame:
    """Events joined to devices, hosts and devices mapped, nulls filled.

    Output: host, browser_type, device_type, os_type, url, user_id,
    event_time, event_date.  ``fill_browser=False`` keeps a null browser
    (the grouping-set reports); the date window is optional.

    The devices side is a dimension: Spark broadcasts it only when its
    measured size is under the broadcast threshold and falls back to a
    sort-merge join otherwise (AQE splits a hot device_id).
    """
    ev = events.select("user_id", "device_id", "host", "url", "event_time")
    if start is not None and end is not None:
        ev = ev.filter(between_dates("event_time", start, end, inclusive_last_day))
    dv = devices.select("device_id", "browser_type", "device_type", "os_type")
    j = ev.join(dv, "device_id", "inner")
    browser = fill_unknown("browser_type") if fill_browser else F.col("browser_type")
    return j.select(
        map_host("host", host_rules).alias("host"),
        browser.alias("browser_type"),
        map_device("device_type", device_rules).alias("device_type"),
        fill_unknown("os_type").alias("os_type"),
        "url", "user_id", "event_time",
        F.to_date("event_time").alias("event_date"),
    )


def dedup_hits(mapped: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """One row per distinct (dims..., url)."""
    return mapped.select(*dims, "url").dropDuplicates()


def _grain_counts(df: DataFrame, dims: Sequence[str], distinct_url: bool) -> DataFrame:
    """Rows per full-grain combination (R2), or distinct urls per grain."""
    if distinct_url:
        # A8 rows are unique per (grain, url): count(1) over them is the
        # number of distinct urls per grain; a null url is its own row.
        df = dedup_hits(df, dims)
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias("_n"))


def _labelled(agged: DataFrame, dims: Sequence[str], label: str = OVERALL) -> DataFrame:
    return agged.select(*[F.coalesce(F.col(d), F.lit(label)).alias(d) for d in dims],
                        *[c for c in agged.columns if c not in dims])


def grouping_sets(df: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str] = DIMS,
                  distinct_url: bool = True, with_level: bool = False) -> DataFrame:
    """Page hits for the given grouping sets, '(overall)' labels.

    ``distinct_url=True`` counts distinct (grain, url) rows, i.e. runs on
    the A8 collapse; ``False`` counts events.
    """
    grain = _grain_counts(df, dims, distinct_url)
    aggs = [F.sum("_n").alias("page_hits")]
    if with_level:
        aggs.append(agg_level(dims).alias("agg_level"))
    agged = grain.groupingSets([list(s) for s in sets], *dims).agg(*aggs)
    return _labelled(agged, dims)


def rollup(df: DataFrame, dims: Sequence[str] = DIMS, distinct_url: bool = True) -> DataFrame:
    """Hierarchical subtotals over ``dims`` in order."""
    grain = _grain_counts(df, dims, distinct_url)
    return _labelled(grain.rollup(*dims).agg(F.sum("_n").alias("page_hits")), dims)


def cube(df: DataFrame, dims: Sequence[str] = DIMS, distinct_url: bool = True) -> DataFrame:
    """All 2^n subsets of ``dims``."""
    grain = _grain_counts(df, dims, distinct_url)
    return _labelled(grain.cube(*dims).agg(F.sum("_n").alias("page_hits")), dims)


def combo_count(report: DataFrame) -> DataFrame:
    """A10: number of rows of a grouped report, as a one-row frame."""
    return report.agg(F.count(F.lit(1)).alias("combo_count"))


def olap_cube(mapped: DataFrame, ds: str | dt.date, dims: Sequence[str] = DIMS) -> DataFrame:
    """Cube of event counts with ``ds`` and an ``agg_level`` name.

    ``mapped`` is the date-filtered, non-collapsed A7 output.  Output:
    host, browser_type, device_type, os_type, page_hits, ds, agg_level
    (grand total level is '').
    """
    grain = _grain_counts(mapped, dims, distinct_url=False)
    agged = grain.cube(*dims).agg(F.sum("_n").alias("page_hits"),
                                  agg_level(dims).alias("agg_level"))
    return agged.select(*[F.coalesce(F.col(d), F.lit(OVERALL)).alias(d) for d in dims],
                        "page_hits", F.lit(str(ds)).cast("date").alias("ds"), "agg_level")
