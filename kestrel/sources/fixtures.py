"""Stand-in views: the reference's input tables built from the driver's tables.

Each function returns a lazy DataFrame with exactly the columns of the
reference table it stands in for.  The derivations are fixed (they are
the test contract shared with the SQL oracle); they are all built-in
column expressions, so they fuse into the scan's whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.tables import read_table


# fixed values: the host that stands in for each event type; the site names
# must match the LIKE patterns of functions.rules.HOST_RULES
EVENT_HOSTS = (
    ("click", "www.techcreator.io"),
    ("view", "www.eczachly.com"),
    ("purchase", "zachwilson.tech"),
    ("signup", "learn.dataengineer.io"),
    ("error", "other.example.com"),
)


def _props_k() -> Column:
    """The integer ``k`` of ``events.props`` (``{"k": 69}``).

    ``try_cast``: a malformed value gives null (the event then matches no
    device) instead of failing a whole ANSI-mode job on one bad row."""
    return F.get_json_object("props", "$.k").try_cast("bigint")


# ---------------------------------------------------------------------------
# web analytics: web_events, devices, web_events_daily
# ---------------------------------------------------------------------------

def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, device_id, referrer, host, url, event_time from ``events``."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "props")
    k = _props_k()
    et = F.col("event_type")
    host = F.when((et == "error") & (k % 10 == 0), F.lit(None).cast("string"))
    for kind, name in EVENT_HOSTS:
        host = host.when(et == kind, name)
    return ev.select(
        F.col("user_id"),
        k.alias("device_id"),
        F.lit(None).cast("string").alias("referrer"),
        host.alias("host"),
        F.concat(F.lit("/"), et, F.lit("/"), (k % 7).cast("string")).alias("url"),
        F.col("ts").alias("event_time"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """device_id, browser_type, os_type, device_type from every ``customer``.

    The planner picks the join from the measured size of the three columns."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nk = F.col("c_nationkey")
    return c.select(
        F.col("c_custkey").alias("device_id"),
        F.when(nk % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("browser_type"),
        F.when(nk % 4 == 0, "Android").when(nk % 4 == 1, "iOS").when(nk % 4 == 3, "Windows").alias("os_type"),
        F.when(nk % 3 == 0, "Samsung Galaxy").when(nk % 3 == 1, "iPhone").alias("device_type"))


def web_events_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, ds, total_page_visits: events counted per user and day."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts")
    return (ev.groupBy("user_id", F.to_date("ts").alias("ds"))
              .agg(F.count(F.lit(1)).alias("total_page_visits")))


# ---------------------------------------------------------------------------
# long-range activity (growth and retention): orders as events
# ---------------------------------------------------------------------------

def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, device_id, event_time from ``orders`` (79 months of activity)."""
    o = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return o.select(F.col("o_custkey").alias("user_id"),
                    F.col("o_custkey").alias("device_id"),
                    F.col("o_orderdate").alias("event_time"))


def activity_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """device_id, os_type from ``customer`` by market segment."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    seg = F.col("c_mktsegment")
    os_type = (F.when(seg == "BUILDING", "Android").when(seg == "MACHINERY", "iOS")
               .when(seg == "FURNITURE", "ios-web").when(seg == "HOUSEHOLD", "iOS 17"))
    return c.select(F.col("c_custkey").alias("device_id"), os_type.alias("os_type"))


# ---------------------------------------------------------------------------
# daily price bars: one bar per (event_type, day) of ``events``
# ---------------------------------------------------------------------------

def stock_bars_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLC bars with double prices (the form the API delivers).

    Open/close are the first/last value of the day by (ts, event_id), held
    in one fixed-width key (microseconds * 2^64 + event_id), so min_by / max_by
    run as hash aggregates and a symbol-day holding a large share of all
    events is combined map-side before the shuffle, without a sort.
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    order_key = (F.unix_micros(F.col("ts").cast("timestamp")).cast("decimal(18,0)")
                 * F.lit(str(2 ** 64)).cast("decimal(20,0)")
                 + F.col("event_id").cast("decimal(19,0)")).cast("decimal(38,0)")
    bars = (ev.groupBy(F.col("event_type").alias("stock_symbol"), F.to_date("ts").alias("ds"))
              .agg(F.min_by("value", order_key).alias("opening_price"),
                   F.max("value").alias("high_price"),
                   F.min("value").alias("low_price"),
                   F.max_by("value", order_key).alias("closing_price"),
                   F.sum(F.floor("value")).cast("bigint").alias("trade_volume"),
                   F.count(F.lit(1)).alias("trade_count")))
    return bars.select("stock_symbol", F.col("ds").cast("timestamp_ntz").alias("created_ts"),
                       "opening_price", "high_price", "low_price", "closing_price",
                       "trade_volume", "trade_count", "ds")


# ---------------------------------------------------------------------------
# dimensional mart sources (raw_*)
# ---------------------------------------------------------------------------

def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key, nk = F.col("c_custkey"), F.col("c_nationkey")
    user = F.concat(F.lit("u"), key.cast("string"))
    email = (F.when(key % 5 == 0, F.concat(user, F.lit("@example.com")))
             .when(key % 5 == 1, F.concat(user, F.lit("@example.io")))
             .when(key % 5 == 2, F.concat(user, F.lit("@other.org")))
             .when(key % 5 == 3, F.concat(user, F.lit(".example.com"))))
    gender = F.when(nk % 4 == 0, "Male").when(nk % 4 == 1, "Female").when(nk % 4 == 2, "Other")
    return c.select(key.alias("customer_id"), (F.lit(18) + key % 60).alias("age"),
                    gender.alias("gender"), email.alias("email"))


def raw_haunted_houses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return p.select(F.col("p_partkey").alias("haunted_house_id"),
                    F.col("p_name").alias("house_name"),
                    F.col("p_brand").alias("park_area"),
                    F.col("p_type").alias("theme"),
                    (F.lit(1) + F.col("p_size") % 5).alias("fear_level"),
                    F.col("p_size").alias("house_size"))


def raw_haunted_house_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticket per order; visit date = first ship date of its lines.

    The line aggregate is keyed by order, so its output is already
    hash-partitioned on the join key and only ``orders`` is exchanged.
    """
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    first_ship = (read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate")
                  .groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship")))
    t = o.join(first_ship, o["o_orderkey"] == first_ship["l_orderkey"], "left")
    return t.select(F.col("o_orderkey").alias("ticket_id"),
                    F.col("o_custkey").alias("customer_id"),
                    (F.col("o_orderkey") % 200).alias("haunted_house_id"),
                    F.to_date("o_orderdate").alias("purchase_date"),
                    F.to_date("first_ship").alias("visit_date"),
                    F.col("o_orderpriority").alias("ticket_type"),
                    F.col("o_totalprice").alias("ticket_price"))


def raw_customer_feedbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag")
    q = (li.filter(F.col("l_returnflag") == "R").groupBy("l_orderkey")
           .agg(F.sum("l_quantity").cast("bigint").alias("qty")))
    return q.select(F.col("l_orderkey").alias("feedback_id"),
                    F.col("l_orderkey").alias("ticket_id"),
                    (F.lit(1) + F.col("qty") % 5).alias("rating"),
                    F.concat(F.lit("qty "), F.col("qty").cast("string")).alias("comments"))
