import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from kestrel.operators import states as ST
from kestrel.sources import fixtures as fx
from tests.conftest import SF0001, SF001, rows

D = dt.date
STATE_SCHEMA = ("user_id long, first_active_date date, last_active_date date, "
                "current_state string, lifetime_page_visits long")
DAILY_SCHEMA = "user_id long, ds date, total_page_visits long"


def test_transitions(spark):
    y0 = D(2024, 1, 1)
    yesterday = spark.createDataFrame([
        (2, y0, y0, "retained", 5), (3, y0, y0, "churned", 5), (4, y0, y0, "stale", 5),
        (5, y0, y0, "stale", 5), (6, y0, y0, "unknown", 5),
    ], STATE_SCHEMA)
    today = spark.createDataFrame([(1, D(2024, 1, 2), 3), (5, D(2024, 1, 2), 1),
                                   (6, D(2024, 1, 2), 2)], DAILY_SCHEMA)
    out = {r.user_id: r for r in ST.state_step(yesterday, today, "2024-01-02").collect()}
    assert {k: v.current_state for k, v in out.items()} == {
        1: "new", 2: "churned", 3: "stale", 4: "unknown", 5: "resurrected", 6: "unknown"}
    assert out[1].first_active_date == D(2024, 1, 2) and out[1].lifetime_page_visits == 3
    assert out[2].last_active_date == y0 and out[2].lifetime_page_visits == 5
    assert out[5].last_active_date == D(2024, 1, 2) and out[5].lifetime_page_visits == 6
    assert all(v.ds == D(2024, 1, 2) for v in out.values())
    kept = {r.user_id: r.current_state
            for r in ST.state_step(yesterday, today, "2024-01-02", keep_stale=True).collect()}
    assert kept[4] == "stale"


def _fold(spark, daily, start, end, keep_stale=False):
    """A5 applied day by day (the incremental job), collected per day."""
    empty = spark.createDataFrame([], STATE_SCHEMA)
    state, out = empty, []
    day = start
    while day <= end:
        today = daily.filter(F.col("ds") == F.lit(day))
        state = ST.state_step(state, today, day.isoformat(), keep_stale)
        state = spark.createDataFrame(state.collect(), state.schema)   # small fixture: cut plan
        out.extend(state.collect())
        day += dt.timedelta(days=1)
    return sorted(tuple(r) for r in out)


@pytest.mark.parametrize("keep_stale", [False, True])
def test_backfill_equals_fold_random(spark, keep_stale):
    rnd = random.Random(7)
    start = D(2024, 1, 1)
    data = []
    for u in range(12):
        for d in range(20):
            if rnd.random() < 0.35:
                data.append((u, start + dt.timedelta(days=d), rnd.randint(1, 4)))
    daily = spark.createDataFrame(data, DAILY_SCHEMA)
    end = D(2024, 1, 20)
    back = sorted(tuple(r) for r in
                  ST.state_backfill(daily, start, end, keep_stale).collect())
    assert back == _fold(spark, daily, start, end, keep_stale)


def test_backfill_equals_fold_on_events(spark):
    daily = fx.web_events_daily(spark, SF0001)
    start, end = D(2024, 1, 1), D(2024, 1, 31)
    back = sorted(tuple(r) for r in ST.state_backfill(daily, start, end).collect())
    assert back == _fold(spark, daily, start, end)


def test_one_row_per_user_per_day(spark):
    out = ST.state_backfill(fx.web_events_daily(spark, SF001), "2024-01-01", "2024-01-31")
    dup = out.groupBy("user_id", "ds").count().filter("count > 1").count()
    assert dup == 0
    states = {r[0] for r in out.select("current_state").distinct().collect()}
    assert "unknown" in states          # gaps >= 4 occur at sf 0.01


def test_daily_job_on_bucketed_table_equals_backfill(spark):
    import contextlib
    import io

    from kestrel.plans import jobs as J
    from kestrel.plans import storage as S
    daily = fx.web_events_daily(spark, SF0001)
    table = J.ensure_state_table(spark, S.new_table_name("state"), buckets=4)
    day = D(2024, 1, 1)
    while day <= D(2024, 1, 8):
        J.state_day(spark, daily, table, day)
        day += dt.timedelta(days=1)
    J.state_day(spark, daily, table, D(2024, 1, 8))                 # rerun of a day
    back = ST.state_backfill(daily, "2024-01-01", "2024-01-08")
    assert rows(spark.table(table).select(*back.columns)) == rows(back)
    # the state side of the daily join is read bucketed: no exchange above its scan
    y = spark.table(table).filter(F.col("ds") == F.lit(D(2024, 1, 8)))
    step = ST.state_step(y, daily.filter(F.col("ds") == F.lit(D(2024, 1, 9))), "2024-01-09")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        step.explain("formatted")
    assert "Bucketed: true" in buf.getvalue()


def test_the_daily_job_moves_only_todays_rows(spark, tmp_path):
    """The whole write: one exchange (today's activity), a file per bucket and day."""
    import re

    from kestrel.plans import jobs as J
    from kestrel.plans import storage as S
    fx.web_events_daily(spark, SF001).write.parquet(str(tmp_path / "daily"))
    daily = spark.read.schema(DAILY_SCHEMA).parquet(str(tmp_path / "daily"))
    table = J.ensure_state_table(spark, S.new_table_name("state"), buckets=4)
    J.backfill_state_table(spark, daily, table, "2024-01-01", "2024-01-05")
    for day in (D(2024, 1, 6), D(2024, 1, 7), D(2024, 1, 7)):
        J.state_day(spark, daily, table, day)
    files = spark.table(table).select("ds", F.input_file_name().alias("f")).distinct().collect()
    per_day = {}
    for r in files:
        per_day.setdefault(r.ds, []).append(re.search(r"_(\d{5})\.c\d+", r.f).group(1))
    assert {d: sorted(b) for d, b in per_day.items()} == {
        D(2024, 1, d): ["00000", "00001", "00002", "00003"] for d in range(1, 8)}
    target = J.ensure_state_table(spark, S.new_table_name("state"), buckets=4)
    J.state_of_day(spark, daily, table, D(2024, 1, 8)).createOrReplaceTempView("state_of_day")
    plan = spark.sql(f"EXPLAIN INSERT INTO {target} SELECT user_id, first_active_date, last_active_date, "
                     "current_state, lifetime_page_visits, ds FROM state_of_day").first()[0]
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 1 and "hashpartitioning(user_id" in exchanges[0], plan
    assert "REBALANCE" not in plan and "Bucketed: true" in plan


def test_backfill_then_daily_runs(spark):
    from kestrel.plans import jobs as J
    from kestrel.plans import storage as S
    daily = fx.web_events_daily(spark, SF0001)
    table = J.ensure_state_table(spark, S.new_table_name("state"), buckets=4)
    J.backfill_state_table(spark, daily, table, "2024-01-01", "2024-01-10")
    for d in (D(2024, 1, 11), D(2024, 1, 12)):
        J.state_day(spark, daily, table, d)
    back = ST.state_backfill(daily, "2024-01-01", "2024-01-12")
    assert rows(spark.table(table).select(*back.columns)) == rows(back)
