"""Daily user-state tracking: new / retained / churned / resurrected / stale.

Transition table (yesterday's state x today active or idle):

    absent                       active -> new
    new, retained, resurrected   active -> retained     idle -> churned
    churned                      active -> resurrected  idle -> stale
    stale                        active -> resurrected  idle -> unknown
    unknown                      anything -> unknown

The literal rules make 'unknown' absorbing (an idle stale user falls to
the ELSE branch and no branch leaves 'unknown').  ``keep_stale=True``
keeps an idle stale user stale instead.

``state_step`` is the daily incremental job (one full outer join of
yesterday's state with today's activity).  ``state_backfill`` gives the
same rows for a whole date range in one job, from the closed form of the
table: with gap = days since the previous active day and idle = days
since the last active day,

    active: first day -> new; gap 1 -> retained; gap 2..3 -> resurrected;
    idle:   1 -> churned; 2 -> stale; 3+ -> unknown;
    and once any gap >= 4 has occurred, unknown from then on.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACTIVE_STATES = ("new", "resurrected", "retained")


def _date(value: str | dt.date) -> Column:
    return F.lit(str(value)).cast("date")


def state_step(yesterday: DataFrame, today: DataFrame, ds: str | dt.date,
               keep_stale: bool = False) -> DataFrame:
    """A5: yesterday's state (user_id, first_active_date, last_active_date,
    current_state, lifetime_page_visits) merged with today's activity
    (user_id, ds, total_page_visits).  Writes ``ds`` = the run date.

    Both sides are keyed by user_id; when the state table is stored
    bucketed or partitioned by user_id (see ``plans.storage``), the full
    outer join does not re-shuffle the state history each day.
    """
    y = yesterday.select("user_id", "first_active_date", "last_active_date",
                         "current_state", "lifetime_page_visits", F.lit(True).alias("_y"))
    t = today.select("user_id", F.col("ds").alias("t_ds"), "total_page_visits")
    j = t.join(y, "user_id", "full_outer")
    y_absent = F.col("_y").isNull()
    t_active = F.col("t_ds").isNotNull()
    st = F.col("current_state")
    state = (F.when(y_absent, "new")
             .when(st.isin(*ACTIVE_STATES) & ~t_active, "churned")
             .when(st.isin(*ACTIVE_STATES) & t_active, "retained")
             .when(st.isin("stale", "churned") & t_active, "resurrected")
             .when(st.isin("churned") & ~t_active, "stale"))
    if keep_stale:
        state = state.when((st == "stale") & ~t_active, "stale")
    state = state.otherwise("unknown")
    return j.select(
        "user_id",
        F.coalesce("first_active_date", "t_ds").alias("first_active_date"),
        F.coalesce("t_ds", "last_active_date").alias("last_active_date"),
        state.alias("current_state"),
        (F.coalesce("lifetime_page_visits", F.lit(0))
         + F.coalesce("total_page_visits", F.lit(0))).cast("bigint").alias("lifetime_page_visits"),
        _date(ds).alias("ds"),
    )


def state_backfill(daily: DataFrame, start: str | dt.date, end: str | dt.date,
                   keep_stale: bool = False, previous: DataFrame | None = None) -> DataFrame:
    """The state table for every day in [start, end] in one job.

    ``previous`` is the state of the day before ``start``: each of its users
    joins the window as one row at the last active day, with the lifetime so
    far and whether the state was absorbed.  Without it the history starts
    at ``start``.

    ``daily`` is (user_id, ds, total_page_visits) with one row per active
    user-day.  The window is partitioned by user over *daily* rows, so a
    partition holds at most one row per day however many events a user
    has; each active day is then expanded over the idle days that follow
    it (``sequence`` + ``explode``), which is the output itself.
    """
    lo, hi = _date(start), _date(end)
    d = (daily.select("user_id", "ds", "total_page_visits")
              .filter((F.col("ds") >= lo) & (F.col("ds") <= hi))
              .select("*", F.lit(None).cast("date").alias("seed_first"), F.lit(False).alias("seed_unknown")))
    if previous is not None:
        d = d.unionByName(previous.select(
            "user_id", F.col("last_active_date").alias("ds"),
            F.col("lifetime_page_visits").alias("total_page_visits"),
            F.col("first_active_date").alias("seed_first"),
            (F.col("current_state") == "unknown").alias("seed_unknown")))
    w = Window.partitionBy("user_id").orderBy("ds")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = _backfill_columns(d, w, upto)
    until = F.coalesce(F.date_sub("next_ds", 1), hi)
    x = (d.where(until >= lo)
         .select("*", F.explode(F.sequence(F.greatest("ds", lo), until)).alias("day"))
         .withColumn("idle", F.datediff("day", "ds")))
    gap = F.datediff("ds", "prev_ds")
    idle = F.col("idle")
    if keep_stale:
        state = (F.when(idle == 0, F.when(F.col("prev_ds").isNull(), "new")
                        .when(gap == 1, "retained").otherwise("resurrected"))
                 .when(idle == 1, "churned").otherwise("stale"))
    else:
        absorbed = (F.coalesce(F.col("max_gap"), F.lit(0)) >= 4) | F.col("was_unknown")
        state = (F.when(absorbed, "unknown")
                 .when(idle == 0, F.when(F.col("prev_ds").isNull(), "new")
                       .when(gap == 1, "retained").otherwise("resurrected"))
                 .when(idle == 1, "churned").when(idle == 2, "stale").otherwise("unknown"))
    return x.select(
        "user_id", "first_active_date",
        F.col("ds").alias("last_active_date"),
        state.alias("current_state"),
        F.col("lifetime").cast("bigint").alias("lifetime_page_visits"),
        F.col("day").alias("ds"),
    )


def _backfill_columns(d: DataFrame, w: Window, upto: Window) -> DataFrame:
    # lag first, then a running max of the gaps: two window passes that
    # share one partitioning and ordering (one exchange, one sort)
    d = d.select("*", F.lag("ds").over(w).alias("prev_ds"),
                 F.lead("ds").over(w).alias("next_ds"),
                 F.sum("total_page_visits").over(upto).alias("lifetime"),
                 F.coalesce(F.first("seed_first").over(upto), F.first("ds").over(upto)).alias("first_active_date"),
                 F.max("seed_unknown").over(upto).alias("was_unknown"))
    return d.withColumn("max_gap", F.max(F.datediff("ds", "prev_ds")).over(upto))
