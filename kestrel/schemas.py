"""Declared schemas of every table the operators write or read back.

Tables are never schema-inferred: each sink writes one of these and each
read-back passes it to the reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

# cumulative user state, one row per user per ds (partitioned by ds)
USER_STATE = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("first_active_date", T.DateType()),
    T.StructField("last_active_date", T.DateType()),
    T.StructField("current_state", T.StringType()),
    T.StructField("lifetime_page_visits", T.LongType()),
    T.StructField("ds", T.DateType()),
])

# OLAP cube table (partitioned by ds, agg_level)
OLAP_CUBE = T.StructType([
    T.StructField("host", T.StringType()),
    T.StructField("browser_type", T.StringType()),
    T.StructField("device_type", T.StringType()),
    T.StructField("os_type", T.StringType()),
    T.StructField("page_hits", T.LongType()),
    T.StructField("ds", T.DateType()),
    T.StructField("agg_level", T.StringType()),
])

# daily price bars, staging and production (partitioned by ds)
BARS = T.StructType([
    T.StructField("stock_symbol", T.StringType()),
    T.StructField("created_ts", T.TimestampNTZType()),
    T.StructField("opening_price", T.FloatType()),
    T.StructField("high_price", T.FloatType()),
    T.StructField("low_price", T.FloatType()),
    T.StructField("closing_price", T.FloatType()),
    T.StructField("trade_volume", T.LongType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("ds", T.DateType()),
])

# day-partitioned variant: no ds, symbol and created_ts required,
# partitioned by the day of created_ts
BARS_BY_DAY = T.StructType([
    T.StructField("stock_symbol", T.StringType(), nullable=False),
    T.StructField("created_ts", T.TimestampNTZType(), nullable=False),
    T.StructField("opening_price", T.FloatType()),
    T.StructField("high_price", T.FloatType()),
    T.StructField("low_price", T.FloatType()),
    T.StructField("closing_price", T.FloatType()),
    T.StructField("trade_volume", T.LongType()),
    T.StructField("trade_count", T.LongType()),
    T.StructField("created_at_day", T.DateType()),
])

# cumulative last-7 closing prices per symbol (keyed per ds)
LAST7 = T.StructType([
    T.StructField("stock_symbol", T.StringType()),
    T.StructField("last_7_prices", T.ArrayType(T.FloatType())),
    T.StructField("last_update", T.TimestampNTZType()),
    T.StructField("ds", T.DateType()),
])

# one bar of the daily-aggregates API response
API_BAR = T.StructType([
    T.StructField("t", T.LongType()),      # epoch milliseconds
    T.StructField("o", T.DoubleType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("l", T.DoubleType()),
    T.StructField("c", T.DoubleType()),
    T.StructField("v", T.DoubleType()),
    T.StructField("n", T.LongType()),
])

# one landed API response (one JSON object per line)
API_RESPONSE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("resultsCount", T.LongType()),
    T.StructField("results", T.ArrayType(API_BAR)),
])

# what a landed file holds, bar by bar: the bar, its text and why it cannot be used
LANDED_ENTRY = T.StructType(BARS.fields + [
    T.StructField("record", T.StringType()),
    T.StructField("reason", T.StringType()),
])

# dead letters of the bar ingest (partitioned by the run that found them)
REJECTED_BARS = T.StructType([
    T.StructField("ds", T.DateType()),
    T.StructField("stock_symbol", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("record", T.StringType()),
    T.StructField("copies", T.LongType()),
    T.StructField("run", T.StringType()),
])

# accepted e-mail domains seed
VALID_DOMAINS = T.StructType([T.StructField("valid_domain", T.StringType())])

# fact table of visits (ticket grain)
FACT_VISITS = T.StructType([
    T.StructField("ticket_id", T.LongType()),
    T.StructField("customer_id", T.LongType()),
    T.StructField("haunted_house_id", T.LongType()),
    T.StructField("purchase_date", T.DateType()),
    T.StructField("visit_date", T.DateType()),
    T.StructField("ticket_type", T.StringType()),
    T.StructField("ticket_price", T.DoubleType()),
    T.StructField("rating", T.LongType()),
    T.StructField("comments", T.StringType()),
])

# the fact as stored: partitioned by purchase month (a ticket never
# changes month, so a merge touches exactly the months of its source)
FACT_VISITS_STORED = T.StructType(FACT_VISITS.fields + [
    T.StructField("purchase_month", T.DateType()),
])
