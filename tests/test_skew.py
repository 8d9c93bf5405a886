"""Hot-key behaviour: one user holding over a third of all events.

The skewed input is derived from the driver's ``events`` table (copies of
every event re-assigned to one user).  AQE's skew thresholds are lowered
so the mechanism fires at test scale; the results must equal a plain
window over the same rows, and the final plan must show the split join.
"""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import olap as O
from kestrel.operators import sessions as SS
from kestrel.sources import fixtures as fx
from tests.conftest import SF001, rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_session(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed_mapped(spark):
    ev = fx.web_events(spark, SF001)
    # every event copied twice onto one user-day (user 8, 2024-01-05): that
    # single (user, day) key holds two thirds of all rows
    hot = (ev.withColumn("user_id", F.lit(8).cast("bigint"))
             .withColumn("event_time", F.expr(
                 "timestampadd(DAY, datediff(DATE'2024-01-05', to_date(event_time)), event_time)")))
    skewed = ev.unionByName(hot).unionByName(hot)
    return O.map_dims(skewed, fx.devices(spark, SF001), start="2024-01-01", end="2024-12-31")


def test_hot_user_day_join_is_split_and_exact(skew_session):
    spark = skew_session
    m = _skewed_mapped(spark)
    out = SS.day_windows(m)
    got = rows(out, "user_id", "event_time", "first_action_on_date", "last_action_on_date",
               "total_event_today")
    w = Window.partitionBy("user_id", "event_date")
    plain = m.select("user_id", "event_time",
                     F.min("event_time").over(w).alias("first_action_on_date"),
                     F.max("event_time").over(w).alias("last_action_on_date"),
                     F.count("event_time").over(w).alias("total_event_today"))
    assert got == rows(plain)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "isFinalPlan=true" in plan
    assert "skew=true" in plan          # AQE split the hot user-day partitions


def test_running_frame_with_hot_second_and_ties(spark):
    """Running positions stay exact when one user-second (and one exact
    timestamp) holds most of the events, across many input partitions."""
    ev = fx.web_events(spark, SF001)
    same_second = (ev.withColumn("user_id", F.lit(8).cast("bigint"))
                     .withColumn("event_time", F.expr(
                         "timestampadd(MICROSECOND, CAST(pmod(hash(url, event_time), 1000) AS INT), "
                         "TIMESTAMP_NTZ'2024-01-05 10:00:00')")))
    same_instant = (ev.withColumn("user_id", F.lit(8).cast("bigint"))
                      .withColumn("event_time", F.lit("2024-01-05 10:00:00.5").cast("timestamp_ntz")))
    skewed = ev.unionByName(same_second).unionByName(same_instant).repartition(16)
    m = O.map_dims(skewed, fx.devices(spark, SF001))
    ours = SS.running_windows(m).select("user_id", "event_time", "total_event_today",
                                        "first_action_on_date")
    w = Window.partitionBy("user_id", "event_date").orderBy("event_time")
    plain = m.select("user_id", "event_time",
                     F.count("event_time").over(w.rowsBetween(Window.unboundedPreceding, 0))
                      .alias("total_event_today"),
                     F.min("event_time").over(Window.partitionBy("user_id", "event_date"))
                      .alias("first_action_on_date"))
    assert rows(ours) == rows(plain)


def test_aqe_splits_a_hot_join_key(skew_session):
    """The planner-side guard for joins to big dimensions: with a sort-merge
    join, AQE splits the partition of a device holding most events."""
    spark = skew_session
    ev = fx.web_events(spark, SF001)
    hot = ev.withColumn("device_id", F.lit(7).cast("bigint"))
    skewed = ev.unionByName(hot).unionByName(hot)
    dev = (fx.read_table(spark, SF001, "customer").filter("c_custkey < 100")
             .select(F.col("c_custkey").alias("device_id"), "c_mktsegment"))
    j = (skewed.join(dev.hint("shuffle_merge"), "device_id")
               .groupBy("c_mktsegment", "url").agg(F.count("host").alias("n"),
                                                   F.max("event_time").alias("last")))
    got = j.collect()
    plain = (skewed.join(F.broadcast(dev), "device_id")
                   .groupBy("c_mktsegment", "url").agg(F.count("host").alias("n"),
                                                       F.max("event_time").alias("last")))
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in plain.collect())
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        j.explain()
    assert "skew=true" in buf.getvalue()


def test_one_timestamp_is_split_over_tasks(skew_session, monkeypatch):
    """Every event of a hot user-day at one instant: one counted row that several tasks expand."""
    spark = skew_session
    monkeypatch.setattr(SS, "PIECE", 500)
    m = spark.range(20_000).select(
        F.when(F.col("id") % 3 != 0, 8).otherwise(F.col("id")).cast("bigint").alias("user_id"),
        F.lit("2024-01-05").cast("date").alias("event_date"),
        F.lit("2024-01-05 00:00:00").cast("timestamp_ntz").alias("event_time"))
    assert SS.event_ranges(m).where("user_id = 8").count() == 1
    tasks = SS.running_windows(m).where("user_id = 8").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 2 and max(r["count"] for r in tasks) < 13_333 // 2
    hot = SS.running_windows(m).where("user_id = 8").agg(
        F.count("*"), F.count_distinct("total_event_today"), F.max("total_event_today")).first()
    assert tuple(hot) == (13_333, 13_333, 13_333)
