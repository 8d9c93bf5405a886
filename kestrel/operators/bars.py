"""Daily price bars and the cumulative last-7-closes array per symbol."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel import schemas

EPOCH = "1970-01-01 00:00:00"
KEEP = 7


def normalize_bars(raw: DataFrame) -> DataFrame:
    """Cast a bar frame to the declared bar schema (float prices)."""
    return raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.BARS.fields])


def _ntz(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def last7_step(cum: DataFrame, today: DataFrame, ds: str | dt.date, keep: int = KEEP) -> DataFrame:
    """Append today's close to each symbol's array and keep the last ``keep``.

    ``cum`` is (stock_symbol, last_7_prices, last_update) of the day
    before, ``today`` the day's bars.  Symbols only in the past keep their
    array; symbols only today start a one-element array; last_update is
    the later of the two timestamps.  Output carries ``ds`` so the table
    is keyed (and overwritten) per day.

    Both sides are keyed by symbol, one row each, so the full outer join
    moves one row per symbol.
    """
    past = cum.select("stock_symbol", F.col("last_7_prices").alias("held"), F.col("last_update").alias("held_at"))
    close = today.select("stock_symbol", F.array(F.col("closing_price").cast("float")).alias("added"),
                         F.col("created_ts").alias("added_at"), F.col("closing_price").isNull().alias("no_price"))
    none = F.array().cast("array<float>")
    both = past.join(close, "stock_symbol", "full_outer")
    # a bar without a price adds nothing to an array, but starts one
    added = F.when(F.col("added").isNull() | (F.col("no_price") & F.col("held").isNotNull()), none).otherwise(F.col("added"))
    return both.select(
        "stock_symbol",
        _last(F.concat(F.coalesce("held", none), added), keep).alias("last_7_prices"),
        F.greatest(F.coalesce("added_at", _ntz(EPOCH)), F.coalesce("held_at", _ntz(EPOCH))).alias("last_update"),
        F.lit(str(ds)).cast("date").alias("ds"),
    )


def _last(prices: Column, keep: int) -> Column:
    return F.when(F.size(prices) > keep, F.slice(prices, -keep, keep)).otherwise(prices)


def last7_backfill(bars: DataFrame, start: str | dt.date, end: str | dt.date,
                   keep: int = KEEP, previous: DataFrame | None = None) -> DataFrame:
    """The S4 table for every day in [start, end] in one job.

    ``previous`` is the table's day before ``start``; its arrays come first
    in the windows.  Without it the history starts at ``start``.

    A window over each symbol's bars (one row per symbol-day, so the
    partition is bounded by days) collects the last ``keep`` closes; each
    bar day is then carried over the following days without a bar.
    """
    lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    b = (bars.filter((F.col("ds") >= lo) & (F.col("ds") <= hi))
             .select("stock_symbol", "ds", "created_ts",
                     F.when(F.col("closing_price").isNotNull(), F.array(F.col("closing_price").cast("float")))
                      .otherwise(F.array().cast("array<float>")).alias("prices")))
    if previous is not None:
        b = b.unionByName(previous.select("stock_symbol", F.date_sub(lo, 1).alias("ds"),
                                          F.col("last_update").alias("created_ts"), F.col("last_7_prices").alias("prices")))
    w = Window.partitionBy("stock_symbol").orderBy("ds")
    b = b.select(
        "stock_symbol", "ds",
        _last(F.flatten(F.collect_list("prices").over(w.rowsBetween(-(keep - 1), 0))), keep).alias("last_7_prices"),
        F.max("created_ts").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("last_update"),
        F.lead("ds").over(w).alias("next_ds"),
    )
    until = F.coalesce(F.date_sub("next_ds", 1), hi)
    return b.where(until >= lo).select("stock_symbol", "last_7_prices", "last_update",
                                       F.explode(F.sequence(F.greatest("ds", lo), until)).alias("ds"))


def explode_prices(cum: DataFrame) -> DataFrame:
    """(stock_symbol, ds, pos, price, last_update): one row per array slot,
    the comparable form of the array table."""
    return cum.select("stock_symbol", "ds", "last_update",
                      F.posexplode("last_7_prices").alias("pos", "price"))
