import datetime as dt
from decimal import Decimal

from kestrel.operators import growth as G
from kestrel.operators import retention as R
from tests.conftest import rows

D = dt.date


def _monthly(spark, data):
    return spark.createDataFrame(data, "activity_month date, os string, monthly_users_active long")


def test_growth_null_safe_and_rounded(spark):
    m = _monthly(spark, [(D(2024, 1, 1), "iOS", 3), (D(2024, 2, 1), "iOS", 5),
                         (D(2024, 3, 1), "iOS", 0), (D(2024, 4, 1), "iOS", 4)])
    out = rows(G.growth(m), "activity_month", "prior_month_users", "mom_growth_percentage")
    assert out == [(1, None, None), (2, 3, Decimal("66.7")), (3, 5, Decimal("-100.0")),
                   (4, 0, None)]


def test_growth_year_lag_is_by_row(spark):
    full = [(D(2023 + (i // 12), i % 12 + 1, 1), "Android", 10 + i) for i in range(13)]
    out = rows(G.growth(_monthly(spark, full)), "activity_year", "activity_month",
               "prior_year_users")
    assert out[-1] == (2024, 1, 10)          # month 13 sees month 1
    gap = [r for i, r in enumerate(full) if i != 5]       # one month missing
    out = rows(G.growth(_monthly(spark, gap + [(D(2024, 2, 1), "Android", 99)])),
               "activity_year", "activity_month", "prior_year_users")
    assert out[-1] == (2024, 2, 10)          # lag 12 counts rows, not months
    dense = rows(G.growth(_monthly(spark, gap + [(D(2024, 2, 1), "Android", 99)]), densify=True),
                 "activity_year", "activity_month", "prior_year_users")
    assert dense[-1] == (2024, 2, 11)        # calendar lag after densifying


def test_growth_rounds_half_up(spark):
    # 100 * (7 - 8) / 8 = -12.5 exactly; 100 * 1 / 8 = 12.5; 100 * 1 / 6 = 16.666...
    m = _monthly(spark, [(D(2024, 1, 1), "a", 8), (D(2024, 2, 1), "a", 7),
                         (D(2024, 1, 1), "b", 8), (D(2024, 2, 1), "b", 9),
                         (D(2024, 1, 1), "c", 6), (D(2024, 2, 1), "c", 7)])
    out = {r.os: r.mom_growth_percentage for r in G.growth(m).collect() if r.activity_month == 2}
    assert out == {"a": Decimal("-12.5"), "b": Decimal("12.5"), "c": Decimal("16.7")}


def _events(spark, data):
    return spark.createDataFrame(data, "user_id long, event_time timestamp_ntz")


def test_retention_month_end_clamps(spark):
    ev = _events(spark, [(1, dt.datetime(2024, 1, 31, 10)), (1, dt.datetime(2024, 2, 29, 9))])
    r = R.retention(ev).collect()[0]
    assert (r.total_started, r.two_weeks_active, r.one_month_active, r.three_months_active) == \
        (1, 1, 1, 0)


def test_retention_offsets_and_null_user(spark):
    ev = _events(spark, [
        (1, dt.datetime(2024, 3, 1, 8)),                                   # first day only
        (2, dt.datetime(2024, 3, 1, 8)), (2, dt.datetime(2024, 3, 15, 0)),  # exactly +14 days
        (None, dt.datetime(2024, 3, 2, 8)),                                # null user
    ])
    r = R.retention(ev).collect()
    assert len(r) == 1
    assert (r[0].total_started, r[0].two_weeks_active, r[0].one_month_active) == (2, 1, 0)


def test_retention_equals_self_join_form(spark):
    """The one-pass form equals the reference's three self-joins."""
    from tests.conftest import SF0001
    from kestrel.sources import fixtures as fx
    ev = fx.activity(spark, SF0001)
    ev.createOrReplaceTempView("act")
    spark.sql("""CREATE OR REPLACE TEMP VIEW first_days AS
                 SELECT user_id, MIN(to_date(event_time)) AS f FROM act GROUP BY user_id""")
    joined = spark.sql("""
      SELECT CAST(year(u.f) AS BIGINT) first_year, CAST(month(u.f) AS BIGINT) first_month,
        COUNT(DISTINCT u.user_id) total_started,
        COUNT(DISTINCT CASE WHEN a.user_id IS NOT NULL THEN u.user_id END) two_weeks_active,
        COUNT(DISTINCT CASE WHEN b.user_id IS NOT NULL THEN u.user_id END) one_month_active,
        COUNT(DISTINCT CASE WHEN c.user_id IS NOT NULL THEN u.user_id END) three_months_active
      FROM first_days u
      LEFT JOIN (SELECT DISTINCT x.user_id FROM act x JOIN first_days y ON x.user_id = y.user_id
                 WHERE to_date(x.event_time) >= date_add(y.f, 14)) a ON a.user_id = u.user_id
      LEFT JOIN (SELECT DISTINCT x.user_id FROM act x JOIN first_days y ON x.user_id = y.user_id
                 WHERE to_date(x.event_time) >= add_months(y.f, 1)) b ON b.user_id = u.user_id
      LEFT JOIN (SELECT DISTINCT x.user_id FROM act x JOIN first_days y ON x.user_id = y.user_id
                 WHERE to_date(x.event_time) >= add_months(y.f, 3)) c ON c.user_id = u.user_id
      GROUP BY 1, 2""")
    assert rows(R.retention(ev)) == rows(joined.select(*R.retention(ev).columns))


def test_os_rules_are_case_sensitive(spark):
    from kestrel.functions.rules import classify_os
    df = spark.createDataFrame([("Android 14",), ("iOS",), ("ios-web",), ("iOS 17",), (None,)],
                               "os_type string")
    assert [r.os for r in df.select(classify_os("os_type").alias("os")).collect()] == \
        ["Android", "iOS", "iOS", "other", "other"]


def test_growth_matches_exact_half_up_rounding(spark):
    """pct_growth equals exact rational arithmetic rounded half away from zero."""
    import random
    from fractions import Fraction

    from kestrel.functions.growth import pct_growth
    rnd = random.Random(11)
    pairs = [(rnd.randint(0, 10**6), rnd.choice([0, rnd.randint(1, 50), rnd.randint(1, 10**6)]))
             for _ in range(2000)] + [(7, 8), (9, 8), (1, 3), (2, 3), (0, 7), (5, 0)]
    df = spark.createDataFrame(pairs, "cur long, prev long")
    got = {(r.cur, r.prev): r.g for r in df.select("cur", "prev",
                                                    pct_growth("cur", "prev").alias("g")).collect()}

    def exact(cur, prev):
        if prev == 0:
            return None
        x = Fraction(100 * (cur - prev), prev) * 10
        q = (abs(x.numerator) * 2 + x.denominator) // (2 * x.denominator)
        return Decimal(q if x >= 0 else -q) / 10

    for (cur, prev), g in got.items():
        assert g == exact(cur, prev), (cur, prev, g)
