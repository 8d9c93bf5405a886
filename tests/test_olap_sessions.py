import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import olap as O
from kestrel.operators import sessions as SS
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from tests.conftest import SF0001, rows

T = dt.datetime
EV_SCHEMA = "user_id long, device_id long, host string, url string, event_time timestamp_ntz"
DEV_SCHEMA = "device_id long, browser_type string, device_type string, os_type string"


def _mapped(spark, events, devices, **kw):
    return O.map_dims(spark.createDataFrame(events, EV_SCHEMA),
                      spark.createDataFrame(devices, DEV_SCHEMA), **kw)


def test_null_browser_gives_two_overall_rows(spark):
    ev = [(1, 1, "www.techcreator.io", "/a", T(2024, 1, 1)),
          (2, 2, "www.techcreator.io", "/b", T(2024, 1, 1))]
    dv = [(1, None, "Samsung Galaxy", "Android"), (2, "Chrome", "iPhone", "iOS")]
    m = _mapped(spark, ev, dv, fill_browser=False)
    gs = O.grouping_sets(m, [O.DIMS, ("host",), ("browser_type",)], with_level=True)
    host_rows = [r for r in gs.collect() if r.host == "TechCreator.io"
                 and r.browser_type == "(overall)"]
    assert len(host_rows) == 2                     # real null browser + host subtotal
    assert {r.agg_level for r in host_rows} == {"host__browser_type__device_type__os_type", "host"}


def test_cube_levels_and_sums(spark):
    m = O.map_dims(fx.web_events(spark, SF0001), fx.devices(spark, SF0001),
                   start="2024-01-01", end="2024-12-31")
    cube = O.olap_cube(m, "2024-12-31")
    levels = {r.agg_level: r.s for r in
              cube.groupBy("agg_level").agg(F.sum("page_hits").alias("s")).collect()}
    n = m.count()
    assert len(levels) == 16 and set(levels.values()) == {n}   # every set sums to all events
    assert levels[""] == n and "host__browser_type__device_type__os_type" in levels


def test_count_then_cube_equals_cube_of_events(spark):
    """R2: the pre-aggregated cube equals SQL CUBE over raw rows."""
    m = O.map_dims(fx.web_events(spark, SF0001), fx.devices(spark, SF0001),
                   start="2024-01-01", end="2024-12-31")
    m.createOrReplaceTempView("m")
    raw = spark.sql("""
      SELECT coalesce(host, '(overall)') host, coalesce(browser_type, '(overall)') browser_type,
             coalesce(device_type, '(overall)') device_type, coalesce(os_type, '(overall)') os_type,
             count(1) page_hits
      FROM m GROUP BY CUBE (host, browser_type, device_type, os_type)""")
    ours = O.olap_cube(m, "2024-12-31").drop("ds", "agg_level")
    assert rows(ours) == rows(raw.select(*ours.columns))


def test_last_day_bound(spark):
    ev = [(1, 1, "x", "/a", T(2024, 1, 20, 0, 0, 0)), (1, 1, "x", "/a", T(2024, 1, 20, 0, 0, 1))]
    dv = [(1, "b", "d", "o")]
    m = _mapped(spark, ev, dv, start="2024-01-01", end="2024-01-20")
    assert m.count() == 1
    m2 = _mapped(spark, ev, dv, start="2024-01-01", end="2024-01-20", inclusive_last_day=True)
    assert m2.count() == 2


def test_grand_total_partition_round_trip(spark):
    ev = [(1, 1, "www.eczachly.com", "/a", T(2024, 1, 1)), (2, 1, None, "/b", T(2024, 1, 1))]
    m = _mapped(spark, ev, [(1, None, None, None)])
    cube = O.olap_cube(m, "2024-01-31")
    table = S.new_table_name("cube_test")
    S.write_cube(spark, cube, table)
    total = S.read_level(spark, table, "2024-01-31", "").collect()
    assert len(total) == 1 and total[0].agg_level == "" and total[0].page_hits == 2
    full = S.read_level(spark, table, "2024-01-31", "host__browser_type__device_type__os_type")
    assert full.count() == 2
    S.write_cube(spark, cube, table)                 # rerun: same rows
    assert spark.table(table).count() == cube.count()


def test_minutes_are_whole_elapsed(spark):
    ev = [(1, 1, "x", "/a", T(2024, 1, 2, 0, 0, 59)), (1, 1, "x", "/a", T(2024, 1, 2, 0, 1, 1)),
          (1, 1, "x", "/a", T(2024, 1, 2, 0, 2, 59))]
    m = _mapped(spark, ev, [(1, "b", "d", "o")])
    out = rows(SS.sessionize(m), "event_time", "minutes_since_first", "total_event_today",
               "last_action_on_date")
    assert [r[1] for r in out] == [0, 0, 2]
    assert {r[2] for r in out} == {3} and {r[3] for r in out} == {T(2024, 1, 2, 0, 2, 59)}
    run = rows(SS.sessionize(m, frame="running"), "event_time", "total_event_today",
               "last_action_on_date")
    assert [(r[1], r[2]) for r in run] == [(1, ev[0][4]), (2, ev[1][4]), (3, ev[2][4])]


def test_running_frame_equals_window(spark):
    """The two-level running count equals a plain window count."""
    from pyspark.sql import Window
    m = O.map_dims(fx.web_events(spark, SF0001), fx.devices(spark, SF0001))
    w = Window.partitionBy("user_id", "event_date").orderBy("event_time") \
        .rowsBetween(Window.unboundedPreceding, 0)
    plain = m.select("user_id", "event_time", F.count("event_time").over(w).alias("n"))
    ours = SS.running_windows(m).select("user_id", "event_time",
                                        F.col("total_event_today").alias("n"))
    assert rows(ours) == rows(plain)


def test_multi_event_days_filter(spark):
    m = O.map_dims(fx.web_events(spark, SF0001), fx.devices(spark, SF0001))
    out = SS.multi_event_days(m)
    assert out.filter("total_event_today <= 1").count() == 0
    singles = SS.day_windows(m).filter("total_event_today = 1").count()
    assert out.count() + singles == m.count()


def test_null_user_is_its_own_group(spark):
    ev = [(None, 1, "x", "/a", T(2024, 1, 2, 8)), (None, 1, "x", "/a", T(2024, 1, 2, 9)),
          (5, 1, "x", "/a", T(2024, 1, 2, 8, 30))]
    m = _mapped(spark, ev, [(1, "b", "d", "o")])
    full = rows(SS.sessionize(m), "user_id", "event_time", "total_event_today",
                "first_action_on_date")
    assert full == [(5, T(2024, 1, 2, 8, 30), 1, T(2024, 1, 2, 8, 30)),
                    (None, T(2024, 1, 2, 8), 2, T(2024, 1, 2, 8)),
                    (None, T(2024, 1, 2, 9), 2, T(2024, 1, 2, 8))]
    run = rows(SS.sessionize(m, frame="running"), "user_id", "event_time", "total_event_today")
    assert run == [(5, T(2024, 1, 2, 8, 30), 1), (None, T(2024, 1, 2, 8), 1),
                   (None, T(2024, 1, 2, 9), 2)]
