"""User-day sessions: first/last action, event count, minutes since first.

The full-frame window values (first_value / last_value / count over
``ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING`` ordered by
event_time) are order statistics of the whole user-day, so they are
computed as a grouped aggregate (min, max, count) and joined back on
(user_id, event_date).  Unlike a window, the aggregate is combined
map-side, and the join back is a sort-merge join that AQE's skew-join
rule splits when one user-day holds a large share of the events, so no
single task has to hold a hot user-day (``tests/test_skew.py`` shows the
split on a user-day holding two thirds of all rows).

The running frame (UNBOUNDED PRECEDING to CURRENT ROW) needs each
event's position inside its user-day.  Events of one user at one time are alike
in every column of the result, so they are counted first; the different times
are range-partitioned, which is decided by their key alone, and a user-day's
ranges are offset by their counts (:func:`running_windows`).  No window
partition and no task grows with a hot user-day or a hot timestamp, and a task
that is run again deals every row as before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import work_dir

KEY = ("user_id", "event_date")
# null-safe group key for the running frame's windows: PARTITION BY treats
# a null user (or day) as a group of its own
NKEY = ("_uk", "_un", "_dk", "_dn")


def _with_group_key(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.coalesce(F.col("user_id"), F.lit(0).cast("bigint")).alias("_uk"),
        F.col("user_id").isNull().alias("_un"),
        F.coalesce(F.col("event_date"), F.lit("1970-01-01").cast("date")).alias("_dk"),
        F.col("event_date").isNull().alias("_dn"))


def _day_stats(mapped: DataFrame) -> DataFrame:
    return (mapped.groupBy(*KEY)
                  .agg(F.min("event_time").alias("first_action_on_date"),
                       F.max("event_time").alias("last_action_on_date"),
                       F.count("event_time").alias("total_event_today")))


def day_windows(mapped: DataFrame) -> DataFrame:
    """Per event row: user_id, event_time, first/last action of its user-day
    and the number of events that day (full frame).

    The join back is null-safe (``<=>``), so both of its inputs arrive
    through their own shuffle on the join keys: the event rows, and the
    per-day stats (one row per user-day, a small exchange).  That shape is
    what AQE's skew-join rule needs to split a hot user-day's partition
    over several tasks and replicate its single stats row to each.
    """
    ev = mapped.select(*KEY, "event_time").alias("r")
    stats = _day_stats(mapped).alias("s")
    cond = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in KEY]
    j = ev.join(stats, cond, "inner")
    return j.select("r.user_id", "r.event_time", "s.first_action_on_date",
                    "s.last_action_on_date", "s.total_event_today")


def _minutes(start: str, end: str):
    """Whole elapsed minutes (DATE_DIFF('minute', start, end))."""
    return F.timestamp_diff("MINUTE", F.col(start), F.col(end))


def sessionize(mapped: DataFrame, frame: str = "full") -> DataFrame:
    """Per event, user-day first/last action, count and minutes.

    ``frame="full"`` is the whole user-day; ``frame="running"`` is the
    frame up to the current row (last action = the event itself, count =
    events so far in event-time order).
    """
    if frame == "full":
        out = day_windows(mapped)
    elif frame == "running":
        out = running_windows(mapped)
    else:
        raise ValueError("frame must be 'full' or 'running'")
    return out.withColumn("minutes_since_first",
                          _minutes("first_action_on_date", "event_time"))


PIECE = 100_000               # equal events that one row is expanded to at a time


def event_ranges(mapped: DataFrame) -> DataFrame:
    """The different (user-day, event time) with their number of events ``_n``, in ranges
    of that order (``_range``); written to the shared folder when called, so that the
    ranges' bounds, which come from a sample, are one for every reader."""
    spark = mapped.sparkSession
    ev = _with_group_key(mapped.select(*KEY, "event_time").filter(F.col("event_time").isNotNull()))
    times = ev.groupBy(*NKEY, *KEY, "event_time").agg(F.count(F.lit(1)).alias("_n"))
    ranged = (times.repartitionByRange(*NKEY, "event_time").withColumn("_range", F.spark_partition_id()))
    path = work_dir(spark, "running")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def running_windows(mapped: DataFrame) -> DataFrame:
    """Running frame (ROWS UNBOUNDED PRECEDING .. CURRENT ROW) from ranges.

    Equal events (one user, one time) are counted map-side and the different
    times range-partitioned by (user, day, time): a key that no two rows share, so
    a row's range depends on nothing but its own values.  A user-day's count and
    first time per range (a row per user-day and range) give the events before
    each range; inside a range a window sums them up.  A row of ``n`` equal events
    is expanded last, to positions that follow one another; more than ``PIECE``
    are dealt out in pieces first.
    """
    ranged = event_ranges(mapped)
    held = ranged.groupBy(*NKEY, "_range").agg(F.sum("_n").alias("_sum"), F.min("event_time").alias("_since"))
    ranges = Window.partitionBy(*NKEY).orderBy("_range")
    held = held.select(
        *NKEY, "_range",
        F.coalesce(F.sum("_sum").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.min("_since").over(Window.partitionBy(*NKEY)).alias("first_action_on_date"))
    inside = Window.partitionBy(*NKEY, "_range").orderBy("event_time").rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(held, [*NKEY, "_range"]).select(
        "user_id", "event_time", "first_action_on_date", "_n",
        (F.col("_before") + F.sum("_n").over(inside) - F.col("_n")).alias("_from"))
    few = placed.where(F.col("_n") <= PIECE).select("*", F.lit(0).cast("bigint").alias("_piece"))
    many = placed.where(F.col("_n") > PIECE).select(
        "*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {PIECE}"))).alias("_piece"))
    many = many.repartition("user_id", "event_time", "_piece")
    first, last = F.col("_piece") * PIECE + 1, F.least((F.col("_piece") + 1) * PIECE, F.col("_n"))
    out = few.unionByName(many).select("*", F.explode(F.sequence(first, last)).alias("_k"))
    return out.select("user_id", "event_time", "first_action_on_date",
                      F.col("event_time").alias("last_action_on_date"),
                      (F.col("_from") + F.col("_k")).alias("total_event_today"))


def multi_event_days(mapped: DataFrame, min_events: int = 1) -> DataFrame:
    """Event rows whose user-day has more than ``min_events`` events
    (the QUALIFY of the reference, as a filter on the joined count)."""
    return day_windows(mapped).filter(F.col("total_event_today") > min_events)
