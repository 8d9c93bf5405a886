"""Row counts and sums listed in FIXTURES.md section 2 (sf 0.001 column)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel import queries as Qy
from kestrel.operators import growth as G
from kestrel.operators import marts as M
from kestrel.operators import olap as O
from kestrel.operators import retention as R
from kestrel.operators import sessions as SS
from kestrel.sources import fixtures as fx
from tests.conftest import SF0001


def _count_sum(df):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum("page_hits").alias("s")).first()
    return r.n, r.s


@pytest.mark.parametrize("name, expect", [
    ("grouping_sets_hits", (254, 1230)), ("rollup_hits", (384, 2050)), ("cube_hits", (739, 6560)),
    ("olap_cube_levels", (739, 16000)),
])
def test_grouped_reports(spark, name, expect):
    assert _count_sum(Qy.QUERIES[name](spark, SF0001)) == expect


def _mapped(spark, end):
    return O.map_dims(fx.web_events(spark, SF0001), fx.devices(spark, SF0001),
                      start="2024-01-01", end=end)


def test_cube_last_day_bound(spark):
    assert _count_sum(O.olap_cube(_mapped(spark, "2024-01-20"), "2024-01-20")) == (719, 10704)


@pytest.mark.parametrize("end, expect", [("2024-12-31", (1000, 901)), ("2024-01-20", (669, 615))])
def test_sessions(spark, end, expect):
    m = _mapped(spark, end)
    assert (SS.sessionize(m).count(), SS.multi_event_days(m).count()) == expect


def test_growth_and_retention(spark):
    g = G.growth(G.monthly_active(fx.activity(spark, SF0001), fx.activity_devices(spark, SF0001)))
    r = g.agg(F.count(F.lit(1)), F.count("prior_month_users"), F.count("prior_year_users")).first()
    assert tuple(r) == (238, 235, 202)
    ret = R.retention(fx.activity(spark, SF0001)).agg(
        F.count(F.lit(1)), F.sum("total_started"), F.sum("two_weeks_active"),
        F.sum("one_month_active"), F.sum("three_months_active")).first()
    assert tuple(ret) == (26, 150, 150, 150, 149)


def test_fact_bars_and_gaps(spark):
    fact = M.fact_visits(fx.raw_haunted_house_tickets(spark, SF0001),
                         fx.raw_customer_feedbacks(spark, SF0001))
    assert (fact.count(), fact.filter(F.col("rating").isNotNull()).count()) == (1500, 1096)
    assert fx.stock_bars_raw(spark, SF0001).count() == 150
    daily = fx.web_events_daily(spark, SF0001)
    w = Window.partitionBy("user_id").orderBy("ds")
    gaps = daily.select(F.datediff("ds", F.lag("ds").over(w)).alias("g"))
    r = gaps.agg(F.max("g"), F.count(F.when(F.col("g") >= 4, 1))).first()
    assert tuple(r) == (3, 0)
    audit = M.audit_fact_visits(fx.raw_haunted_house_tickets(spark, SF0001),
                                fx.raw_customer_feedbacks(spark, SF0001), "1995-06-19")
    assert audit.count() == 5
