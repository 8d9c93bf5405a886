import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.plans import jobs as J
from kestrel.plans import publish as P
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from kestrel.sources import landed as L
from tests.conftest import SF0001, rows


def test_build_marts_materializes_and_tests(spark):
    names = J.build_marts(spark, SF0001, prefix="t")
    assert spark.table(names["fact_visits"]).count() == 1500
    assert spark.table(names["dim_customers"]).filter("is_valid_email_address").count() > 0
    assert set(names) >= {"stg_haunted_customers", "dim_haunted_houses"}


def test_build_fact_visits_audits_then_merges(spark):
    table = S.new_table_name("fact")
    day = "1995-06-19"                     # 5 tickets at sf 0.001
    res = J.build_fact_visits(spark, SF0001, day, table)
    assert res.passed
    assert {r.status for r in res.results.collect()} == {"pass"}
    first = rows(spark.table(table))
    assert len(first) == 5
    J.build_fact_visits(spark, SF0001, day, table)     # rerun: unchanged
    assert rows(spark.table(table)) == first


def _land(spark, path, rows_):
    """API responses of (symbol, day, close)."""
    raw = spark.createDataFrame([(s, dt.datetime.combine(d, dt.time()), c, c, c, c, 10, 1, d) for s, d, c in rows_],
                                "stock_symbol string, created_ts timestamp_ntz, opening_price double, high_price double, "
                                "low_price double, closing_price double, trade_volume long, trade_count long, ds date")
    return L.land_api_responses(spark, raw, path)


def _last7(spark, cum, day):
    return rows(spark.table(cum).filter(F.col("ds") == F.lit(day)), "stock_symbol", "last_7_prices")


def test_run_day_ingest_publish_cumulate(spark, tmp_path):
    raw = fx.stock_bars_raw(spark, SF0001)
    landing = L.land_api_responses(spark, raw, str(tmp_path / "landing"))
    prod, cum = S.new_table_name("prod"), S.new_table_name("cum")
    days = [dt.date(2024, 1, d) for d in range(1, 9)]
    for d in days:
        J.run_day(spark, landing, d, prod, cum)
    J.run_day(spark, landing, days[-1], prod, cum)            # rerun of the last day
    bars = L.ingest_bars(spark, landing).filter(F.col("ds") <= F.lit(days[-1]))
    expect = B.last7_backfill(bars, days[0], days[-1]).filter(F.col("ds") == F.lit(days[-1]))
    assert _last7(spark, cum, days[-1]) == rows(expect, "stock_symbol", "last_7_prices")
    assert spark.table(prod).count() == bars.count()


def test_days_without_bars_carry_the_arrays(spark, tmp_path):
    thu, fri, mon = (dt.date(2024, 2, d) for d in (1, 2, 5))
    landing = _land(spark, str(tmp_path / "l"), [("x", thu, 1.0), ("x", fri, 2.0), ("x", mon, 3.0)])
    prod, cum = S.new_table_name("prod"), S.new_table_name("cum")
    ran = [J.run_day(spark, landing, thu + dt.timedelta(k), prod, cum) for k in range(5)]
    assert ran == [True, True, False, False, True]
    assert _last7(spark, cum, mon) == [("x", [1.0, 2.0, 3.0])]
    assert _last7(spark, cum, dt.date(2024, 2, 4)) == [("x", [1.0, 2.0])]
    with pytest.raises(P.GateFailed):                          # a day was skipped
        J.cumulate_day(spark, prod, cum, dt.date(2024, 2, 9))
    J.run_day(spark, landing, dt.date(2024, 2, 7), prod, cum)  # the scheduled job fills the gap
    assert _last7(spark, cum, dt.date(2024, 2, 7)) == [("x", [1.0, 2.0, 3.0])]


def test_state_table_refuses_gaps_and_backfills_continue(spark):
    days = [dt.date(2024, 1, 30) + dt.timedelta(k) for k in range(8)]
    active = {"a": (0, 1, 5), "b": (0, 4), "c": (3,), "d": (0, 7)}
    daily = spark.createDataFrame([(ord(u), days[k], 5) for u, ks in active.items() for k in ks],
                                  "user_id long, ds date, total_page_visits long")
    whole, parts, steps = (J.ensure_state_table(spark, S.new_table_name("st"), 4) for _ in range(3))
    J.backfill_state_table(spark, daily, whole, days[0], days[-1])
    J.backfill_state_table(spark, daily, parts, days[0], days[3])
    J.backfill_state_table(spark, daily, parts, days[4], days[-1])
    for day in [*days, days[-1]]:
        J.state_day(spark, daily, steps, day)
    columns = schemas.USER_STATE.fieldNames()
    assert rows(spark.table(parts), *columns) == rows(spark.table(whole), *columns) == rows(spark.table(steps), *columns)
    for late in (lambda: J.state_day(spark, daily, whole, days[-1] + dt.timedelta(2)),
                 lambda: J.backfill_state_table(spark, daily, whole, days[-1] + dt.timedelta(3), days[-1] + dt.timedelta(4))):
        with pytest.raises(P.GateFailed):
            late()
    assert spark.table(whole).count() == spark.table(steps).count()


def test_last7_backfill_continues_from_the_stored_day(spark):
    bars = B.normalize_bars(fx.stock_bars_raw(spark, SF0001))
    prod, cum = S.new_table_name("prod"), S.new_table_name("cum")
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, bars, prod)
    J.backfill_cumulative(spark, prod, cum, "2024-01-01", "2024-01-10")
    J.backfill_cumulative(spark, prod, cum, "2024-01-11", "2024-01-31")
    assert rows(spark.table(cum), *schemas.LAST7.fieldNames()) == rows(
        B.last7_backfill(bars, "2024-01-01", "2024-01-31").select(*schemas.LAST7.fieldNames()))


def test_a_failing_model_stops_those_built_from_it(spark):
    models = J.mart_models(spark, SF0001)
    models["stg_customer_feedbacks"] = models["stg_customer_feedbacks"].withColumn("rating", F.lit(9).cast("bigint"))
    with pytest.raises(P.GateFailed, match="rating"):
        J.build_marts(spark, SF0001, prefix="bad", models=models)
    assert not spark.catalog.tableExists("bad_fact_visits") and spark.table("bad_dim_customers").count() > 0


def test_built_fact_takes_audit_merges(spark):
    names = J.build_marts(spark, SF0001, prefix="m")
    before = rows(spark.table(names["fact_visits"]).drop("purchase_month"))
    res = J.build_fact_visits(spark, SF0001, "1995-06-19", names["fact_visits"])
    assert res.passed
    assert rows(spark.table(names["fact_visits"]).drop("purchase_month")) == before
