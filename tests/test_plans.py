"""Plan guards: every registered query stays JVM-side and join-safe, and
date windows reach the parquet scan."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from kestrel.queries import QUERIES
from tests.conftest import SF0001

NAMES = sorted(QUERIES)           # those of kestrel.llm may run Python


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_no_python(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, (name, bad)


@pytest.mark.parametrize("name", ["olap_cube_levels", "session_minutes", "multi_event_days",
                                  "user_state_backfill", "wap_gate", "audit_fact_visits"])
def test_date_window_is_pushed_to_the_scan(spark, name):
    plan = _plan(E.queries()[name](spark, SF0001))
    pushed = [line for line in plan.splitlines() if line.startswith("PushedFilters")]
    assert any("GreaterThanOrEqual(ts" in p or "GreaterThanOrEqual(o_orderdate" in p
               for p in pushed), (name, pushed)


def test_scan_reads_only_needed_columns(spark):
    plan = _plan(E.queries()["stock_bars"](spark, SF0001))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas == ["ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,"
                       "event_type:string,value:double>"]


def test_cluster_profile_keys_are_spark_settings(spark):
    from kestrel.session import CLUSTER_CONF, DEFAULT_CONF
    known = {r[0] for r in spark.sql("SET -v").collect()}
    static_ok = {"spark.ui.enabled", "spark.sql.execution.arrow.pyspark.enabled"}
    for key in list(CLUSTER_CONF) + list(DEFAULT_CONF):
        assert key in known or key in static_ok, key


def test_bars_aggregate_without_a_sort(spark):
    plan = _plan(E.queries()["stock_bars"](spark, SF0001))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_checks_of_a_model_take_one_pass(spark):
    from kestrel.operators import quality as Q
    from kestrel.plans.jobs import MART_CHECKS
    fact = E.queries()["fact_visits"](spark, SF0001)
    scans = lambda df: sum(line.startswith("Location: ") for line in _plan(df).splitlines())
    assert scans(Q.run_checks("fact_visits", fact, MART_CHECKS["fact_visits"])) <= scans(fact)
