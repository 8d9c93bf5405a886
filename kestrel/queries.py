"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the stand-in views of
``sources.fixtures``) and runs over all of their rows.  Queries that
exercise a sink write to fresh catalog tables under the shared work
folder and return what they read back.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.operators import growth as G
from kestrel.operators import marts as M
from kestrel.operators import olap as O
from kestrel.operators import quality as Q
from kestrel.operators import retention as R
from kestrel.operators import sessions as SS
from kestrel.operators import states as ST
from kestrel.plans import jobs as J
from kestrel.plans import publish as P
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from kestrel.sources import landed as L
from kestrel.sources.seeds import land_domains, read_seed, valid_domains

# --- query parameters (dates inside the driver tables' ranges) -------------
WEB_START, WEB_END = "2024-01-01", "2024-12-31"      # web window (literal last-day bound)
DAY_START, DAY_END = "2024-01-01", "2024-01-31"      # daily jobs: all of January 2024
STEP_DAY = "2024-01-15"                              # one incremental run
AUDIT_DATE = "1996-09-17"                            # purchase date of the audit day
DATELESS = 50                                        # every so many-th stored ticket lacks its date
CUBE_LEVEL = "device_type__os_type"                  # level read back from the cube table

Query = Callable[[SparkSession, str], DataFrame]


# --- analytical patterns ----------------------------------------------------

def _mapped(spark, sf, fill_browser=True, window=True) -> DataFrame:
    kw = dict(start=WEB_START, end=WEB_END) if window else {}
    return O.map_dims(fx.web_events(spark, sf), fx.devices(spark, sf),
                      fill_browser=fill_browser, **kw)


def _raw_mapped(spark, sf) -> DataFrame:
    """The grouping-set reports' input: browser not filled, no date window."""
    return _mapped(spark, sf, fill_browser=False, window=False)


def os_monthly_active(spark, sf):
    return G.monthly_active(fx.activity(spark, sf), fx.activity_devices(spark, sf))


def os_growth_mom_yoy(spark, sf):
    return G.order_growth(G.growth(os_monthly_active(spark, sf)))


def os_growth_order(spark, sf):
    """The growth report with the place of each row."""
    return Q.with_position(os_growth_mom_yoy(spark, sf))


def retention_order(spark, sf):
    """The retention report with the place of each row."""
    return Q.with_position(retention_monthly(spark, sf))


def user_first_activity(spark, sf):
    return R.first_activity(fx.activity(spark, sf))


def retention_monthly(spark, sf):
    return R.order_retention(R.retention(fx.activity(spark, sf)))


def _daily(spark, sf):
    return fx.web_events_daily(spark, sf)


def user_state_backfill(spark, sf):
    return ST.state_backfill(_daily(spark, sf), DAY_START, DAY_END)


def user_state_step(spark, sf):
    prev = F.date_sub(F.lit(STEP_DAY).cast("date"), 1)
    yesterday = (ST.state_backfill(_daily(spark, sf), DAY_START, DAY_END)
                 .filter(F.col("ds") == prev))
    today = _daily(spark, sf).filter(F.col("ds") == F.lit(STEP_DAY).cast("date"))
    return ST.state_step(yesterday, today, STEP_DAY)


def web_mapped(spark, sf):
    return _mapped(spark, sf)


def web_mapped_dedup(spark, sf):
    return O.dedup_hits(_raw_mapped(spark, sf))


GROUPING_SETS = (O.DIMS, ("host",), ("browser_type",))


def grouping_sets_hits(spark, sf):
    return O.grouping_sets(_raw_mapped(spark, sf), GROUPING_SETS)


def grouping_sets_combo_count(spark, sf):
    return O.combo_count(grouping_sets_hits(spark, sf))


def rollup_hits(spark, sf):
    return O.rollup(_raw_mapped(spark, sf))


def cube_hits(spark, sf):
    return O.cube(_raw_mapped(spark, sf))


def olap_cube_levels(spark, sf):
    return O.olap_cube(_mapped(spark, sf), WEB_END)


def olap_cube_slice(spark, sf):
    table = S.new_table_name("web_events_olap_cube")
    S.write_cube(spark, olap_cube_levels(spark, sf), table)
    return S.read_level(spark, table, WEB_END, CUBE_LEVEL)


def session_minutes(spark, sf):
    return SS.sessionize(_mapped(spark, sf), frame="full")


def session_running(spark, sf):
    return SS.sessionize(_mapped(spark, sf), frame="running")


def multi_event_days(spark, sf):
    return SS.multi_event_days(_mapped(spark, sf))


# --- bars -------------------------------------------------------------------

def _bars(spark, sf):
    return B.normalize_bars(fx.stock_bars_raw(spark, sf))


def _comparable_bars(df: DataFrame) -> DataFrame:
    """Float prices widened to double (exact), for comparison."""
    return df.select(*[F.col(c).cast("double").alias(c)
                       if c in ("opening_price", "high_price", "low_price", "closing_price")
                       else F.col(c) for c in df.columns])


def stock_bars(spark, sf):
    return _comparable_bars(_bars(spark, sf))


def ingest_bars(spark, sf):
    landing = L.land_api_responses(spark, fx.stock_bars_raw(spark, sf))
    return _comparable_bars(L.ingest_bars(spark, landing))


def ingest_quarantine(spark, sf):
    """Damaged landed responses through the ingest: the bars that stay and, with the reason,
    those that are rejected."""
    landing = L.land_damaged_responses(spark, fx.stock_bars_raw(spark, sf))
    with S.scratch(spark, L.entries(L.read_landed(spark, landing)), schemas.LANDED_ENTRY) as found:
        kept, rejected = L.sort_out(spark.table(found))
        prod = S.ensure_table(spark, S.new_table_name("stock_bars_prod"), schemas.BARS, ("ds",))
        S.insert_overwrite_dynamic(spark, kept, prod)
        letters = J.reject(spark, rejected, prod, "all")
    bars = _comparable_bars(spark.table(prod)).select(
        "ds", "stock_symbol", "created_ts", "closing_price", F.lit("kept").alias("outcome"), F.lit(1).cast("bigint").alias("copies"))
    return bars.unionByName(spark.table(letters).select(
        "ds", "stock_symbol", F.lit(None).cast("timestamp_ntz").alias("created_ts"),
        F.lit(None).cast("double").alias("closing_price"), F.col("reason").alias("outcome"), "copies"))


def bars_by_day(spark, sf):
    table = S.new_table_name("stock_prices")
    J.write_bars_by_day(spark, _bars(spark, sf), table)
    return _comparable_bars(spark.table(table))


def last7_backfill(spark, sf):
    cum = B.last7_backfill(_bars(spark, sf), DAY_START, DAY_END)
    return B.explode_prices(cum).withColumn("price", F.col("price").cast("double"))


def last7_step(spark, sf):
    bars = _bars(spark, sf)
    prev = F.date_sub(F.lit(STEP_DAY).cast("date"), 1)
    cum = B.last7_backfill(bars, DAY_START, DAY_END).filter(F.col("ds") == prev)
    today = bars.filter(F.col("ds") == F.lit(STEP_DAY).cast("date"))
    out = B.last7_step(cum, today, STEP_DAY)
    return B.explode_prices(out).withColumn("price", F.col("price").cast("double"))


# --- mart ------------------------------------------------------------------

def stg_customers(spark, sf):
    return M.stg_customers(fx.raw_customers(spark, sf))


def stg_feedbacks(spark, sf):
    return M.stg_feedbacks(fx.raw_customer_feedbacks(spark, sf))


def stg_houses(spark, sf):
    return M.stg_houses(fx.raw_haunted_houses(spark, sf))


def stg_tickets(spark, sf):
    return M.stg_tickets(fx.raw_haunted_house_tickets(spark, sf))


def valid_domains_seed(spark, sf):
    """A seed written from the customers' addresses and read with its declared schema: each
    domain with its customers, each line that does not fit."""
    customers = stg_customers(spark, sf)
    seed = read_seed(spark, land_domains(spark, customers), schemas.VALID_DOMAINS, header=False)
    counted = customers.groupBy(F.split_part("email", F.lit("@"), F.lit(2)).alias("valid_domain")).agg(
        F.count(F.lit(1)).alias("customers"))
    good = seed.where("bad_line IS NULL").select("valid_domain").join(counted, "valid_domain", "left")
    return good.select("valid_domain", "customers", F.lit(None).cast("string").alias("bad_line")).unionByName(
        seed.where("bad_line IS NOT NULL").select("valid_domain", F.lit(None).cast("bigint").alias("customers"), "bad_line"))


def dim_customers(spark, sf):
    return M.dim_customers(stg_customers(spark, sf), valid_domains(spark))


def dim_houses(spark, sf):
    return M.dim_houses(stg_houses(spark, sf))


def feet_to_meters(spark, sf):
    from kestrel.functions.units import feet_to_meters as f2m
    h = stg_houses(spark, sf)
    return h.select("haunted_house_id", "house_size",
                    f2m("house_size").alias("size_m_scale2"),
                    f2m("house_size", scale=4).alias("size_m_scale4"))


def fact_visits(spark, sf):
    return M.fact_visits(stg_tickets(spark, sf), stg_feedbacks(spark, sf))


def audit_fact_visits(spark, sf):
    return M.audit_fact_visits(stg_tickets(spark, sf), stg_feedbacks(spark, sf), AUDIT_DATE)


def fact_visits_merge(spark, sf):
    """Merge the audit day into a stored fact where a quarter of its tickets
    is missing, a quarter lacks the feedback, a quarter lies in another month
    and a quarter has no purchase date; some other tickets have none either."""
    day = F.lit(AUDIT_DATE).cast("date")
    part = F.col("ticket_id") % 4
    audited = F.col("purchase_date").eqNullSafe(day)
    fact = fact_visits(spark, sf).where(~audited | (part != 0))
    lacks = audited & (part == 1)
    stored = fact.withColumns({
        "rating": F.when(~lacks, F.col("rating")),
        "comments": F.when(~lacks, F.col("comments")),
        "purchase_date": F.when(audited & (part == 2), F.date_add(day, 45))
                          .when(~((audited & (part == 3)) | (F.col("ticket_id") % DATELESS == 0)) | lacks,
                                F.col("purchase_date"))})
    table = J.ensure_fact_table(spark, S.new_table_name("fact_visits"))
    S.insert_overwrite_dynamic(spark, J.with_fact_partition(stored), table)
    J.merge_into_fact(spark, table, audit_fact_visits(spark, sf))
    return spark.table(table).select(*M.FACT_COLUMNS)


def mart_build(spark, sf):
    """Build and test the marts, then read the stored fact back with the
    columns that it gets from each dimension."""
    names = J.build_marts(spark, sf, prefix=S.new_table_name("mart"))
    fact, customers, houses = (spark.table(names[n]) for n in ("fact_visits", "dim_customers", "dim_haunted_houses"))
    return (fact.join(customers.select("customer_id", "is_valid_email_address"), "customer_id", "left")
            .join(houses.select("haunted_house_id", "house_name", "house_size_in_m2"), "haunted_house_id", "left")
            .select(*M.FACT_COLUMNS, "is_valid_email_address", "house_name", "house_size_in_m2"))


FAILED_DATE = "1995-06-19"                           # purchase date whose audit fails


def fact_audit_job(spark, sf):
    """P7's audit variant: one purchase day passes its tests and is merged into a fact that
    lacks it, another one, whose houses are not among the dimension's, is refused."""
    days = [F.lit(d).cast("date") for d in (AUDIT_DATE, FAILED_DATE)]
    table = J.ensure_fact_table(spark, S.new_table_name("fact_visits"))
    stored = fact_visits(spark, sf).where(~F.coalesce(F.col("purchase_date").isin(*days), F.lit(False)))
    S.insert_overwrite_dynamic(spark, J.with_fact_partition(stored), table)
    models = J.mart_models(spark, sf)
    without_houses = {**models, "dim_haunted_houses": models["dim_haunted_houses"].where("haunted_house_id < 0")}
    results = [J.build_fact_visits(spark, sf, AUDIT_DATE, table, models),
               J.build_fact_visits(spark, sf, FAILED_DATE, table, without_houses)]
    S.drop_table(spark, results[1].audit_table)
    passed = spark.createDataFrame([(d, r.passed) for d, r in zip((AUDIT_DATE, FAILED_DATE), results)], "day string, passed boolean")
    fact = spark.table(table).select(*M.FACT_COLUMNS)
    audits = passed.select(F.col("day").cast("date").alias("purchase_date"), F.col("passed").cast("string").alias("comments"))
    return fact.unionByName(audits, allowMissingColumns=True)


def dq_unit_dim_customers(spark, sf):
    """T8 over every customer: the expected flag follows from the address's kind; then the same
    rows with the flag of every seventh customer wrong."""
    customers = stg_customers(spark, sf)
    actual = dim_customers(spark, sf)
    flag = F.coalesce(F.col("email").rlike("^[^@]*@example[.](com|io)$"), F.lit(False))
    expected = customers.withColumn("is_valid_email_address", flag).select(*actual.columns)
    seventh = F.col("customer_id") % 7 == 0
    wrong = expected.withColumn("is_valid_email_address", F.col("is_valid_email_address") != seventh)
    return Q.unit_result("as expected", actual, expected).unionByName(
        Q.unit_result("every seventh flag wrong", actual, wrong))


def dq_audit_checks(spark, sf):
    """The six declared tests of the audit day, foreign keys to both dimensions
    included; houses hold only the larger ones, so one of them fails."""
    parents = {"dim_customers": dim_customers(spark, sf),
               "dim_haunted_houses": dim_houses(spark, sf).where("haunted_house_id > 20")}
    return Q.run_checks("audit_fact_visits", audit_fact_visits(spark, sf), J.AUDIT_CHECKS, parents)


# --- stored history: several daily runs, a day without rows, a rerun ------------

JOB_START = "2024-01-27"                             # first day run by the daily job
RERUN_DAY = "2024-01-29"


def _job_days():
    first, last = (dt.date.fromisoformat(d) for d in (JOB_START, DAY_END))
    return [first + dt.timedelta(k) for k in range((last - first).days + 1)]


def last7_job(spark, sf):
    """Backfill up to the day before, then day by day through the stored table
    (the last day has no bars), one day rerun; the days that the job ran."""
    prod, cum = S.new_table_name("stock_bars_prod"), S.new_table_name("last7")
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark, sf), prod)
    J.backfill_cumulative(spark, prod, cum, DAY_START, str(_job_days()[0] - dt.timedelta(1)))
    for day in [*_job_days(), RERUN_DAY]:
        J.cumulate_day(spark, prod, cum, day)
    out = spark.table(cum).where(F.col("ds") >= F.lit(JOB_START).cast("date"))
    return B.explode_prices(out).withColumn("price", F.col("price").cast("double"))


STATE_BUCKETS = 8                                    # of the registered queries' small state tables


def user_state_job(spark, sf):
    """The state table by daily runs after a backfill; the last day has no activity."""
    table = J.ensure_state_table(spark, S.new_table_name("user_state"), STATE_BUCKETS)
    J.backfill_state_table(spark, _daily(spark, sf), table, DAY_START, str(_job_days()[0] - dt.timedelta(1)))
    for day in [*_job_days(), RERUN_DAY]:
        J.state_day(spark, _daily(spark, sf), table, day)
    return spark.table(table).where(F.col("ds") >= F.lit(JOB_START).cast("date")).select(*schemas.USER_STATE.fieldNames())


def user_state_late_backfill(spark, sf):
    """Two backfills, the second from the middle of the month on."""
    table = J.ensure_state_table(spark, S.new_table_name("user_state"), STATE_BUCKETS)
    middle = dt.date.fromisoformat(STEP_DAY)
    J.backfill_state_table(spark, _daily(spark, sf), table, DAY_START, str(middle - dt.timedelta(1)))
    J.backfill_state_table(spark, _daily(spark, sf), table, STEP_DAY, DAY_END)
    return spark.table(table).select(*schemas.USER_STATE.fieldNames())


def cumulative_clear(spark, sf):
    """A cumulative day that holds other rows is cleared and inserted again; the other days stay."""
    prod, cum = S.new_table_name("stock_bars_prod"), S.new_table_name("last7")
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark, sf), prod)
    J.backfill_cumulative(spark, prod, cum, DAY_START, STEP_DAY)
    day = spark.table(cum).where(F.col("ds") == F.lit(STEP_DAY).cast("date"))
    other = day.withColumn("stock_symbol", F.concat(F.lit("old_"), "stock_symbol"))
    S.insert_overwrite_partition(spark, day.unionByName(other).drop("ds"), cum, {"ds": STEP_DAY})
    J.cumulate_day(spark, prod, cum, STEP_DAY)
    return B.explode_prices(spark.table(cum)).withColumn("price", F.col("price").cast("double"))


def table_layouts(spark, sf):
    """Tables as jobs declare and fill them, read back from the catalog; a day is
    published twice, a bucketed day run, a staging table dropped."""
    bars, state, flat = (S.new_table_name(n) for n in ("bars", "state", "dim"))
    S.ensure_table(spark, bars, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark, sf), bars)
    for _ in range(2):
        P.publish_partition(spark, _bars(spark, sf), bars, STEP_DAY)
    J.ensure_state_table(spark, state, STATE_BUCKETS)
    J.backfill_state_table(spark, _daily(spark, sf), state, DAY_START, STEP_DAY)
    S.ensure_table(spark, flat, schemas.VALID_DOMAINS)
    S.insert_overwrite_table(spark, valid_domains(spark), flat)
    dropped = S.ensure_table(spark, S.new_table_name("gone"), schemas.BARS, ("ds",))
    S.drop_table(spark, dropped)
    out = None
    for name, table in (("bars", bars), ("state", state), ("domains", flat)):
        rows = S.read_back(spark, table).select(F.lit(name).alias("table_name"), "kind", "name", "detail")
        out = rows if out is None else out.unionByName(rows)
    gone = spark.createDataFrame([("gone", "exists", str(spark.catalog.tableExists(dropped)).lower(), "")], out.schema)
    return out.unionByName(gone)


# --- publish ------------------------------------------------------------------

def wap_gate(spark, sf):
    """The gate for a day with bars and for one without."""
    bars = _bars(spark, sf)
    gate = lambda ds: P.gate_nonempty(bars, ds).select(F.lit(ds).cast("date").alias("ds"), "dq_check")
    return gate(STEP_DAY).unionByName(gate(DAY_END))


def wap_publish(spark, sf):
    """Production holds every day, the step day with wrong prices and a symbol
    too many; the step day is published twice."""
    bars = _bars(spark, sf)
    table = S.new_table_name("stock_bars_prod")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    wrong = F.col("ds") == F.lit(STEP_DAY).cast("date")
    prices = {c: F.when(wrong, F.lit(-1)).otherwise(F.col(c)).cast("float").alias(c) for c in ("opening_price", "closing_price")}
    stale = bars.withColumns(prices)
    extra = bars.where(wrong).withColumn("stock_symbol", F.concat(F.lit("old_"), "stock_symbol"))
    S.insert_overwrite_dynamic(spark, stale.unionByName(extra), table)
    for _ in range(2):
        P.publish_partition(spark, bars, table, STEP_DAY)
    return _comparable_bars(spark.table(table).select(*schemas.BARS.fieldNames()))


def audit_then_publish(spark, sf):
    """Production holds the days before the step day; the step day goes
    through write-audit-publish."""
    return _comparable_bars(J.publish_bars_day(spark, _bars(spark, sf), STEP_DAY,
                                               history_before=True))


def overwrite_snapshot(spark, sf):
    """The day-partitioned bar table holds every day; a new fetch of the
    step day replaces the whole table (snapshot overwrite)."""
    bars = _bars(spark, sf)
    table = S.new_table_name("stock_prices")
    J.write_bars_by_day(spark, bars, table)
    fetched = bars.filter(F.col("ds") == F.lit(STEP_DAY).cast("date"))
    J.overwrite_bars_by_day(spark, fetched, table)
    return _comparable_bars(spark.table(table))


# --- data tests ----------------------------------------------------------------

def dq_not_null(spark, sf):
    return Q.not_null(stg_tickets(spark, sf), "visit_date")


def dq_unique(spark, sf):
    return Q.unique(stg_tickets(spark, sf), "haunted_house_id")


def dq_accepted_values(spark, sf):
    """Ratings outside a list that lacks the highest (nulls skipped by ``where``)."""
    return Q.accepted_values(fact_visits(spark, sf), "rating", [1, 2, 3, 4],
                             where="rating IS NOT NULL")


def dq_relationships(spark, sf):
    """Audit-day tickets whose customer is not among those with a valid address."""
    return Q.relationships(audit_fact_visits(spark, sf), "customer_id",
                           dim_customers(spark, sf).where("is_valid_email_address"), "customer_id")


def dq_is_positive(spark, sf):
    c = fx.read_table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return Q.is_positive(c, "c_acctbal")


def dq_valid_email(spark, sf):
    return Q.valid_email(stg_customers(spark, sf), "email")


def dq_nonempty(spark, sf):
    return Q.day_counts(_bars(spark, sf), DAY_START, DAY_END)


def dq_mart_checks(spark, sf):
    """Every declared test of the mart models, as failure counts."""
    return J.mart_check_results(spark, sf)


QUERIES: dict[str, Query] = {
    # analytical patterns
    "os_monthly_active": os_monthly_active,
    "os_growth_mom_yoy": os_growth_mom_yoy,
    "os_growth_order": os_growth_order,
    "user_first_activity": user_first_activity,
    "retention_monthly": retention_monthly,
    "retention_order": retention_order,
    "user_state_step": user_state_step,
    "user_state_backfill": user_state_backfill,
    "user_state_job": user_state_job,
    "user_state_late_backfill": user_state_late_backfill,
    "web_mapped": web_mapped,
    "web_mapped_dedup": web_mapped_dedup,
    "grouping_sets_hits": grouping_sets_hits,
    "grouping_sets_combo_count": grouping_sets_combo_count,
    "rollup_hits": rollup_hits,
    "cube_hits": cube_hits,
    "olap_cube_levels": olap_cube_levels,
    "olap_cube_slice": olap_cube_slice,
    "session_minutes": session_minutes,
    "session_running": session_running,
    "multi_event_days": multi_event_days,
    # bars
    "stock_bars": stock_bars,
    "ingest_bars": ingest_bars,
    "ingest_quarantine": ingest_quarantine,
    "bars_by_day": bars_by_day,
    "last7_step": last7_step,
    "last7_backfill": last7_backfill,
    "last7_job": last7_job,
    "cumulative_clear": cumulative_clear,
    # mart
    "stg_customers": stg_customers,
    "stg_feedbacks": stg_feedbacks,
    "stg_houses": stg_houses,
    "stg_tickets": stg_tickets,
    "valid_domains": valid_domains_seed,
    "dim_customers": dim_customers,
    "dim_houses": dim_houses,
    "feet_to_meters": feet_to_meters,
    "fact_visits": fact_visits,
    "audit_fact_visits": audit_fact_visits,
    "fact_visits_merge": fact_visits_merge,
    "mart_build": mart_build,
    "fact_audit_job": fact_audit_job,
    "table_layouts": table_layouts,
    # publish
    "wap_gate": wap_gate,
    "wap_publish": wap_publish,
    "audit_then_publish": audit_then_publish,
    "overwrite_snapshot": overwrite_snapshot,
    # data tests
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_relationships": dq_relationships,
    "dq_is_positive": dq_is_positive,
    "dq_valid_email": dq_valid_email,
    "dq_nonempty": dq_nonempty,
    "dq_mart_checks": dq_mart_checks,
    "dq_audit_checks": dq_audit_checks,
    "dq_unit_dim_customers": dq_unit_dim_customers,
}
