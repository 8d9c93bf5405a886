import datetime as dt

from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.sources import fixtures as fx
from kestrel.sources import landed as L
from tests.conftest import SF0001, rows

D, T = dt.date, dt.datetime
CUM = "stock_symbol string, last_7_prices array<float>, last_update timestamp_ntz"
TODAY = "stock_symbol string, closing_price double, created_ts timestamp_ntz"


def test_step_lengths_and_carry(spark):
    cum = spark.createDataFrame([
        ("A", [], T(2024, 1, 1)),
        ("B", [float(i) for i in range(6)], T(2024, 1, 1)),
        ("C", [float(i) for i in range(7)], T(2024, 1, 1)),
        ("D", [float(i) for i in range(8)], T(2024, 1, 1)),
        ("P", [1.0, 2.0], T(2023, 12, 30)),               # only in the past
    ], CUM)
    today = spark.createDataFrame([(s, 9.0, T(2024, 1, 2)) for s in "ABCDN"], TODAY)
    out = {r.stock_symbol: r for r in B.last7_step(cum, today, "2024-01-02").collect()}
    assert {k: len(v.last_7_prices) for k, v in out.items()} == \
        {"A": 1, "B": 7, "C": 7, "D": 7, "N": 1, "P": 2}
    assert out["D"].last_7_prices == [2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 9.0]
    assert out["N"].last_7_prices == [9.0] and out["N"].last_update == T(2024, 1, 2)
    assert out["P"].last_7_prices == [1.0, 2.0] and out["P"].last_update == T(2023, 12, 30)


def test_step_fold_equals_backfill(spark):
    bars = B.normalize_bars(fx.stock_bars_raw(spark, SF0001))
    start, end = D(2024, 1, 1), D(2024, 1, 31)
    cum = spark.createDataFrame([], CUM)
    folded = []
    day = start
    while day <= end:
        today = bars.filter(F.col("ds") == F.lit(day))
        step = B.last7_step(cum, today, day.isoformat())
        got = step.collect()
        folded += [(r.stock_symbol, r.ds, tuple(r.last_7_prices), r.last_update) for r in got]
        cum = spark.createDataFrame([(r.stock_symbol, r.last_7_prices, r.last_update)
                                     for r in got], CUM)
        day += dt.timedelta(days=1)
    back = [(r.stock_symbol, r.ds, tuple(r.last_7_prices), r.last_update)
            for r in B.last7_backfill(bars, start, end).collect()]
    assert sorted(folded) == sorted(back)


def test_normalize_matches_schema(spark):
    bars = B.normalize_bars(fx.stock_bars_raw(spark, SF0001))
    assert bars.schema.simpleString() == schemas.BARS.simpleString()
    assert bars.count() == 150


def test_ingest_skips_delayed_and_empty(spark, tmp_path):
    raw = fx.stock_bars_raw(spark, SF0001)
    path = L.land_api_responses(spark, raw, str(tmp_path / "landing"))
    got = L.ingest_bars(spark, path)
    expect = raw.filter((F.col("trade_count") % 7 != 0) & (F.col("trade_count") % 11 != 0))
    assert got.count() == expect.count() > 0
    one_day = L.ingest_bars(spark, path, "2024-01-03")
    assert set(r.ds for r in one_day.collect()) == {D(2024, 1, 3)}
    assert rows(got, "stock_symbol", "ds", "trade_count") == \
        rows(expect, "stock_symbol", "ds", "trade_count")
