"""Landed daily-aggregate API responses: write (for tests) and ingest.

The reference fetches one HTTP response per ticker per day; here the
responses are files already landed on shared storage, one JSON object
per line, in folders ``ds=YYYY-MM-DD`` named by load date.  Ingest is a
schema-declared JSON read, a filter, and an ``explode`` of ``results``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.session import work_dir

LANDED = T.StructType(schemas.API_RESPONSE.fields + [T.StructField("ds", T.DateType())])


def _responses(bars_raw: DataFrame) -> DataFrame:
    """One response per (symbol, day).  Those whose trade count is a multiple of 7
    are 'DELAYED' and those with a multiple of 11 empty (resultsCount 0)."""
    item = F.struct(
        F.unix_millis(F.col("created_ts").cast("timestamp")).alias("t"),
        F.col("opening_price").alias("o"), F.col("high_price").alias("h"),
        F.col("low_price").alias("l"), F.col("closing_price").alias("c"),
        F.col("trade_volume").cast("double").alias("v"), F.col("trade_count").alias("n"))
    empty = F.col("trade_count") % 11 == 0
    return bars_raw.select(
        F.col("stock_symbol").alias("ticker"),
        F.when(F.col("trade_count") % 7 == 0, "DELAYED").otherwise("OK").alias("status"),
        F.when(empty, F.lit(0)).otherwise(F.lit(1)).cast("bigint").alias("resultsCount"),
        F.when(empty, F.array().cast(T.ArrayType(schemas.API_BAR)))
         .otherwise(F.array(item)).alias("results"),
        "ds")


def land_api_responses(spark: SparkSession, bars_raw: DataFrame, path: str | None = None) -> str:
    """Write API-shaped responses derived from a bar frame; returns the path.
    Some are DELAYED or empty, so ingest has both kinds to skip."""
    out = path or work_dir(spark, "landing")
    _responses(bars_raw).write.mode("overwrite").partitionBy("ds").json(out)
    return out


def land_damaged_responses(spark: SparkSession, bars_raw: DataFrame, path: str | None = None) -> str:
    """The responses as lines, some of them damaged by their trade count: a multiple of 13 lands
    again a second later, of 17 has its closing price negated, of 19 loses the end of its
    line, of 23 its ticker."""
    out = path or work_dir(spark, "landing")
    n = F.col("trade_count")
    again = bars_raw.where(n % 13 == 0).withColumn("created_ts", F.expr("created_ts + INTERVAL 1 SECOND"))
    rows = bars_raw.unionByName(again).withColumns({
        "closing_price": F.when(n % 17 == 0, -F.col("closing_price")).otherwise(F.col("closing_price")),
        "stock_symbol": F.when(n % 23 != 0, F.col("stock_symbol"))})
    broken = rows.withColumn("cut", n % 19 == 0)
    # the trade count marks the damage, and is not part of a response's own columns
    lines = _responses(broken.where("cut")).select("ds", F.to_json(F.struct("ticker", "status", "resultsCount", "results")).alias("value"))
    lines = lines.withColumn("value", F.expr("left(value, length(value) - 12)"))
    whole = _responses(broken.where("NOT cut")).select("ds", F.to_json(F.struct("ticker", "status", "resultsCount", "results")).alias("value"))
    lines.unionByName(whole).write.mode("overwrite").partitionBy("ds").text(out)
    return out


def ingest_bars(spark: SparkSession, path: str, ds: str | dt.date | None = None) -> DataFrame:
    """Landed responses -> bars (BARS schema).

    Skips DELAYED and empty responses, flattens ``results`` and tags each
    bar with its symbol and load date.  A ``ds`` argument prunes the read
    to that load date's folder.
    """
    raw = spark.read.schema(LANDED).json(path)
    if ds is not None:
        raw = raw.filter(F.col("ds") == F.lit(str(ds)).cast("date"))
    return flatten_responses(raw)


# what makes a landed bar unusable; the first reason that holds is given
MALFORMED, REPEATED = "malformed response", "repeated symbol"
ROW_FAULTS = (
    ("no load date", "ds IS NULL"),
    ("no symbol", "stock_symbol IS NULL"),
    ("no time", "created_ts IS NULL"),
    ("price not positive", "closing_price <= 0"),
)
CORRUPT = "_corrupt_record"
#: the landed schema with the text of a line that does not fit it
LANDED_LINES = T.StructType(LANDED.fields[:-1] + [T.StructField(CORRUPT, T.StringType()), LANDED["ds"]])


def read_landed(spark: SparkSession, path: str, ds: str | dt.date | None = None) -> DataFrame:
    """Landed responses, a line that is no such response included (as ``_corrupt_record``)."""
    raw = spark.read.schema(LANDED_LINES).option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return raw if ds is None else raw.filter(F.col("ds") == F.lit(str(ds)).cast("date"))


def entries(raw: DataFrame) -> DataFrame:
    """Every bar of landed responses, and every malformed one, with its text and the
    reason why it cannot be used (null: it can).  DELAYED and empty responses are no faults
    and give no row.  ``raw`` is :func:`read_landed` or the same as a stream's batch."""
    bad = F.col(CORRUPT).isNotNull()
    fine = (F.coalesce(F.col("status"), F.lit("")) != "DELAYED") & (F.coalesce(F.col("resultsCount"), F.lit(0)) > 0)
    none = F.array().cast(T.ArrayType(schemas.API_BAR))
    items = (F.when(bad, F.array(F.lit(None).cast(schemas.API_BAR)))
             .when(fine, F.coalesce("results", none)).otherwise(none))
    rows = raw.select(F.when(~bad, F.col("ticker")).alias("ticker"), "ds", CORRUPT, F.explode(items).alias("r"))
    rows = rows.select(*_bar_columns(), F.coalesce(CORRUPT, F.to_json(F.struct("ticker", "r"))).alias("record"),
                       F.col(CORRUPT).isNotNull().alias("_bad"))
    reason = F.when(F.col("_bad"), MALFORMED)
    for name, fault in ROW_FAULTS:
        reason = reason.when(F.expr(fault), name)
    return rows.withColumn("reason", reason).drop("_bad")


def sort_out(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The usable bars of (stored) :func:`entries`, one per symbol and load date, and the
    rejected rows: ds, stock_symbol, reason, record, copies.

    Of several bars of a symbol and date the one of the latest time stays (ties: the greatest
    in its other columns), the others are repeats.  Equal rows are counted before any
    shuffle, so a symbol that is repeated without end is one row of each task."""
    columns = schemas.BARS.fieldNames()
    key, rest = ["stock_symbol", "ds"], [c for c in columns if c not in ("stock_symbol", "ds")]
    rest.sort(key="created_ts".__ne__)                       # the time decides first
    good = found.where("reason IS NULL").groupBy(*columns).agg(
        F.count(F.lit(1)).alias("copies"), F.max("record").alias("record"))
    best = good.groupBy(*key).agg(F.max(F.struct(*rest)).alias("best"))
    kept = best.select("stock_symbol", "ds", "best.*").select(*columns)
    spare = good.join(best, key).withColumn(
        "copies", F.col("copies") - F.struct(*rest).eqNullSafe(F.col("best")).cast("bigint"))
    rejected = spare.where("copies > 0").select("ds", "stock_symbol", F.lit(REPEATED).alias("reason"), "record", "copies")
    faults = found.where("reason IS NOT NULL").groupBy("ds", "stock_symbol", "reason", "record").agg(
        F.count(F.lit(1)).alias("copies"))
    return kept, rejected.unionByName(faults)


def flatten_responses(raw: DataFrame) -> DataFrame:
    """Landed responses (batch or stream) -> bars: skip DELAYED and empty
    responses, explode ``results``, cast to the bar schema."""
    ok = raw.filter((F.coalesce(F.col("status"), F.lit("")) != "DELAYED")
                    & (F.coalesce(F.col("resultsCount"), F.lit(0)) > 0))
    return ok.select("ticker", "ds", F.explode("results").alias("r")).select(*_bar_columns())


def _bar_columns() -> list[Column]:
    """The bar of an exploded result ``r`` of ``ticker`` and ``ds``."""
    return [
        F.col("ticker").alias("stock_symbol"),
        F.timestamp_millis(F.col("r.t")).cast("timestamp_ntz").alias("created_ts"),
        F.col("r.o").cast("float").alias("opening_price"),
        F.col("r.h").cast("float").alias("high_price"),
        F.col("r.l").cast("float").alias("low_price"),
        F.col("r.c").cast("float").alias("closing_price"),
        F.col("r.v").cast("bigint").alias("trade_volume"),
        F.col("r.n").cast("bigint").alias("trade_count"),
        F.col("ds")]
