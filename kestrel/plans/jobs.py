"""Job compositions: the daily bar job and the mart build.

These are plain functions that call the operators in a fixed order; the
scheduling, retries and dependency graph of the reference's orchestrator
are the caller's (or the cluster scheduler's) business.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.operators import marts as M
from kestrel.operators import quality as Q
from kestrel.operators import states as ST
from kestrel.plans import publish as P
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from kestrel.sources.seeds import valid_domains

# ---------------------------------------------------------------------------
# bars
# ---------------------------------------------------------------------------

BAR_CHECKS = (
    Q.Check("not_null", "stock_symbol"),
    Q.Check("not_null", "created_ts"),
    Q.Check("unique", "stock_symbol"),
    Q.Check("is_positive", "closing_price"),
)


def _by_day(bars: DataFrame) -> DataFrame:
    return bars.select(*[c for c in schemas.BARS_BY_DAY.fieldNames() if c != "created_at_day"],
                       F.to_date("created_ts").alias("created_at_day"))


def write_bars_by_day(spark: SparkSession, bars: DataFrame, table: str) -> None:
    """S3: bars partitioned by the day of ``created_ts`` (a derived
    ``created_at_day`` column); replaces the days present in ``bars``.
    Symbol and timestamp are required: a null in either refuses the batch.
    The batch is written once; the check reads that copy."""
    S.ensure_table(spark, table, schemas.BARS_BY_DAY, ("created_at_day",))
    with S.staged(spark, _by_day(bars), table) as stage:
        bad = spark.table(stage).filter(F.col("stock_symbol").isNull() | F.col("created_ts").isNull())
        if not bad.isEmpty():
            raise P.GateFailed("bars with a null stock_symbol or created_ts")
        S.publish_stage(spark, stage, table)


def overwrite_bars_by_day(spark: SparkSession, bars: DataFrame, table: str) -> None:
    """Replace the whole day-partitioned table with ``bars``; an empty
    batch is refused."""
    P.overwrite_table(spark, _by_day(bars), table)


def publish_bars_day(spark: SparkSession, bars: DataFrame, ds: str | dt.date,
                     table: str | None = None, history_before: bool = False) -> DataFrame:
    """P5 for one day of bars: stage -> audit checks -> partition publish.

    ``history_before=True`` first loads the days before ``ds`` into a new
    production table (used by the registered query).  Returns the
    production table.
    """
    prod = table or S.new_table_name("stock_bars_prod")
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    day = F.lit(str(ds)).cast("date")
    if history_before:
        S.insert_overwrite_dynamic(spark, bars.filter(F.col("ds") < day), prod)
    result = P.audit_partitions(spark, bars.filter(F.col("ds") == day), BAR_CHECKS, prod, model="stock_bars")
    if not result.passed:
        raise P.GateFailed(f"audit failed for {ds}")
    return spark.table(prod).select(*schemas.BARS.fieldNames())


def _day(ds: str | dt.date) -> dt.date:
    return ds if isinstance(ds, dt.date) else dt.date.fromisoformat(str(ds))


def _require_previous(spark: SparkSession, table: str, ds: str | dt.date) -> None:
    """Refuse a day whose predecessor is not in the cumulative ``table``,
    unless nothing before it is: the first day starts the history."""
    days = S.partition_dates(spark, table)
    if any(d < _day(ds) for d in days) and _day(ds) - dt.timedelta(1) not in days:
        raise P.GateFailed(f"{table} has earlier days but not the day before {ds}; run that day first")


def cumulate_day(spark: SparkSession, prod: str, cumulative: str, ds: str | dt.date,
                 keep: int = B.KEEP) -> None:
    """S4 as a table step: yesterday's arrays + today's published bars ->
    today's partition of the cumulative table (keyed per ds, so a rerun
    never touches other days).

    A day without bars carries every array forward, so each day has its
    partition and the next one finds it; a missing previous day is refused
    instead of restarting the arrays.
    """
    S.ensure_table(spark, cumulative, schemas.LAST7, ("ds",))
    _require_previous(spark, cumulative, ds)
    day = F.lit(str(ds)).cast("date")
    cum = spark.table(cumulative).filter(F.col("ds") == F.date_sub(day, 1))
    today = spark.table(prod).filter(F.col("ds") == day)
    step = B.last7_step(cum, today, ds, keep)
    S.insert_overwrite_partition(spark, step.drop("ds"), cumulative, {"ds": str(ds)})


def cumulate_through(spark: SparkSession, prod: str, cumulative: str, ds: str | dt.date,
                     keep: int = B.KEEP) -> None:
    """Fold day ``ds`` into the cumulative table, in date order: the days since
    its last one, or, for a late day, every day from ``ds`` on (their arrays
    hold what ``ds`` changed)."""
    S.ensure_table(spark, cumulative, schemas.LAST7, ("ds",))
    days = S.partition_dates(spark, cumulative)
    first, last = _day(ds), _day(ds)
    if days:
        first, last = min(first, days[-1] + dt.timedelta(1)), max(last, days[-1])
    for k in range((last - first).days + 1):
        cumulate_day(spark, prod, cumulative, first + dt.timedelta(k), keep)


def reject(spark: SparkSession, rejected: DataFrame, prod: str, run: str) -> str:
    """Put the dead letters of one run into the table beside ``prod``; returns its name.
    A run that is repeated replaces its own."""
    table = f"{prod}_rejected"
    S.ensure_table(spark, table, schemas.REJECTED_BARS, ("run",))
    S.insert_overwrite_partition(spark, rejected, table, {"run": run})
    return table


def run_day(spark: SparkSession, landing: str, ds: str | dt.date, prod: str, cumulative: str,
            keep: int = B.KEEP) -> bool:
    """The daily bar job: ingest the landed day -> quarantine -> audit -> publish ->
    last-7 step, each a Spark job; rerunning a day rewrites the same
    partitions.  Landed rows that cannot be used go to the dead letters of
    :func:`reject`, the others are published.  A day without bars publishes
    nothing and carries the arrays forward; returns whether the day had bars."""
    from kestrel.sources import landed as L
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    with S.scratch(spark, L.entries(L.read_landed(spark, landing, ds)), schemas.LANDED_ENTRY) as found:
        kept, rejected = L.sort_out(spark.table(found))
        reject(spark, rejected, prod, f"day-{ds}")
        some = not kept.isEmpty()
        if some:
            publish_bars_day(spark, kept, ds, table=prod)
    cumulate_through(spark, prod, cumulative, ds, keep)
    return some


# ---------------------------------------------------------------------------
# user state table
# ---------------------------------------------------------------------------

def ensure_state_table(spark: SparkSession, table: str, buckets: int) -> str:
    """P1 for the state table: partitioned by ds, each day bucketed by user_id.

    ``buckets`` is the number of tasks of the daily job, so size it to the
    state: rows of a day / rows that a task should hold.  A day is one file a
    bucket."""
    return S.ensure_table(spark, table, schemas.USER_STATE, ("ds",),
                          bucket_by=("user_id",), buckets=buckets)


def state_day(spark: SparkSession, daily: DataFrame, table: str, ds: str | dt.date,
              keep_stale: bool = False) -> None:
    """A5 as the daily job: yesterday's partition (+) today's activity ->
    today's partition of the state table.

    Yesterday's partition is read bucketed by user_id, and the join's tasks, a
    bucket each, write today's buckets as they are: only today's activity is
    shuffled, and each state row is written once, a file per bucket.  A
    day whose predecessor is missing is refused (everybody would be lost).  A
    rerun of the day gives the same rows.
    """
    _require_previous(spark, table, ds)
    S.insert_overwrite_partition(spark, state_of_day(spark, daily, table, ds, keep_stale).drop("ds"),
                                 table, {"ds": str(ds)}, aligned=True)


def state_of_day(spark: SparkSession, daily: DataFrame, table: str, ds: str | dt.date,
                 keep_stale: bool = False) -> DataFrame:
    """The rows of ``ds`` from the stored day before and the day's activity, a bucket to a task.

    The day before is given by its literal, so the catalog prunes to its folder."""
    day = _day(ds)
    yesterday = spark.table(table).filter(F.col("ds") == F.lit(day - dt.timedelta(1)))
    return ST.state_step(yesterday, daily.filter(F.col("ds") == F.lit(day)), ds, keep_stale)


def backfill_state_table(spark: SparkSession, daily: DataFrame, table: str,
                         start: str | dt.date, end: str | dt.date,
                         keep_stale: bool = False) -> None:
    """A6 into the state table: every day of [start, end] from one window
    pass, written with one dynamic overwrite of those ``ds`` partitions
    (instead of one join per day), continuing from the stored day before
    ``start``.  Daily ``state_day`` runs continue from the last one."""
    _require_previous(spark, table, start)
    before = spark.table(table).filter(F.col("ds") == F.date_sub(F.lit(str(start)).cast("date"), 1))
    S.insert_overwrite_dynamic(spark, ST.state_backfill(daily, start, end, keep_stale, before), table)


def backfill_cumulative(spark: SparkSession, prod: str, cumulative: str, start: str | dt.date,
                        end: str | dt.date, keep: int = B.KEEP) -> None:
    """S5 into the cumulative table, continuing from the stored day before ``start``."""
    S.ensure_table(spark, cumulative, schemas.LAST7, ("ds",))
    _require_previous(spark, cumulative, start)
    before = spark.table(cumulative).filter(F.col("ds") == F.date_sub(F.lit(str(start)).cast("date"), 1))
    S.insert_overwrite_dynamic(spark, B.last7_backfill(spark.table(prod), start, end, keep, before), cumulative)


# ---------------------------------------------------------------------------
# mart
# ---------------------------------------------------------------------------

# declared tests of each model (nulls pass unless the test is not_null)
MART_CHECKS: dict[str, tuple[Q.Check, ...]] = {
    "stg_customer_feedbacks": (
        Q.Check("unique", "feedback_id"), Q.Check("not_null", "feedback_id"),
        Q.Check("not_null", "ticket_id"),
        Q.Check("accepted_values", "rating", values=(1, 2, 3, 4, 5)),
    ),
    "stg_haunted_customers": (
        Q.Check("unique", "customer_id"), Q.Check("not_null", "customer_id"),
        Q.Check("not_null", "age"), Q.Check("is_positive", "age"),
        Q.Check("accepted_values", "gender", values=("Male", "Female", "Other")),
    ),
    "stg_haunted_house_tickets": (
        Q.Check("unique", "ticket_id"), Q.Check("not_null", "ticket_id"),
        Q.Check("not_null", "customer_id"), Q.Check("not_null", "haunted_house_id"),
    ),
    "stg_haunted_houses": (
        Q.Check("unique", "haunted_house_id"), Q.Check("not_null", "haunted_house_id"),
        Q.Check("not_null", "house_name"),
        Q.Check("accepted_values", "fear_level", values=(1, 2, 3, 4, 5)),
        Q.Check("is_positive", "house_size"),
    ),
    "dim_customers": (
        Q.Check("unique", "customer_id"), Q.Check("not_null", "customer_id"),
        Q.Check("not_null", "age"), Q.Check("is_positive", "age"),
        Q.Check("accepted_values", "gender", where="gender IS NOT NULL",
                values=("Male", "Female", "Other")),
        Q.Check("not_null", "is_valid_email_address"),
    ),
    "dim_haunted_houses": (
        Q.Check("unique", "haunted_house_id"), Q.Check("not_null", "haunted_house_id"),
    ),
    "fact_visits": (
        Q.Check("unique", "ticket_id"), Q.Check("not_null", "ticket_id"),
        Q.Check("not_null", "customer_id"), Q.Check("not_null", "haunted_house_id"),
        Q.Check("not_null", "purchase_date"), Q.Check("not_null", "ticket_price"),
        Q.Check("is_positive", "ticket_price"),
        Q.Check("accepted_values", "rating", where="rating IS NOT NULL", values=(1, 2, 3, 4, 5)),
    ),
}

AUDIT_CHECKS: tuple[Q.Check, ...] = (
    Q.Check("not_null", "ticket_id"), Q.Check("unique", "ticket_id"),
    Q.Check("not_null", "customer_id"),
    Q.Check("relationships", "customer_id", parent="dim_customers", field="customer_id"),
    Q.Check("not_null", "haunted_house_id"),
    Q.Check("relationships", "haunted_house_id", parent="dim_haunted_houses",
            field="haunted_house_id"),
)


def mart_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Staging models and marts as lazy frames (staging = views)."""
    models = {
        "stg_customer_feedbacks": M.stg_feedbacks(fx.raw_customer_feedbacks(spark, sf_dir)),
        "stg_haunted_customers": M.stg_customers(fx.raw_customers(spark, sf_dir)),
        "stg_haunted_house_tickets": M.stg_tickets(fx.raw_haunted_house_tickets(spark, sf_dir)),
        "stg_haunted_houses": M.stg_houses(fx.raw_haunted_houses(spark, sf_dir)),
    }
    models["dim_customers"] = M.dim_customers(models["stg_haunted_customers"], valid_domains(spark))
    models["dim_haunted_houses"] = M.dim_houses(models["stg_haunted_houses"])
    models["fact_visits"] = M.fact_visits(models["stg_haunted_house_tickets"],
                                          models["stg_customer_feedbacks"])
    return models


def mart_check_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure counts of every declared test of the mart models."""
    models = mart_models(spark, sf_dir)
    out = None
    for name, checks in MART_CHECKS.items():
        r = Q.run_checks(name, models[name], checks)
        out = r if out is None else out.unionByName(r)
    return out


STAGING = ("stg_customer_feedbacks", "stg_haunted_customers", "stg_haunted_house_tickets",
           "stg_haunted_houses")
# model -> the models that it is built from
BUILT_FROM = {
    "dim_customers": ("stg_haunted_customers",),
    "dim_haunted_houses": ("stg_haunted_houses",),
    "fact_visits": ("stg_haunted_house_tickets", "stg_customer_feedbacks"),
}


def build_marts(spark: SparkSession, sf_dir: str, prefix: str = "mart",
                models: dict[str, DataFrame] | None = None) -> dict[str, str]:
    """Staging as temp views, marts as tables, tests after each model.

    Returns model -> table (or view) name.  Each model is tested right after
    it is built; one that fails stops those built from it, the others go on,
    and the failures are raised at the end.  Table names are stable: a run
    replaces the tables of the one before, and a mart replaces its table
    only when its own tests pass on the staged copy.
    """
    models = models or mart_models(spark, sf_dir)
    names: dict[str, str] = {}
    failures: list = []

    def tested(model: str, rows: DataFrame) -> bool:
        bad = Q.run_checks(model, rows, MART_CHECKS[model]).filter(F.col("status") == "fail").collect()
        failures.extend(bad)
        return not bad

    for model in STAGING:
        view = f"{prefix}_{model}"
        models[model].createOrReplaceTempView(view)
        if tested(model, spark.table(view)):
            names[model] = view
    for model, parents in BUILT_FROM.items():
        if not all(p in names for p in parents):
            continue
        table = f"{prefix}_{model}"
        if model == "fact_visits":          # in its stored layout, ready for merges
            df = with_fact_partition(models[model])
            ensure_fact_table(spark, table)
        else:
            df = models[model]
            S.ensure_table(spark, table, df.schema)
        with S.staged(spark, df, table) as stage:
            if tested(model, spark.table(stage)):
                S.replace_table(spark, stage, table)
                names[model] = table
    if failures:
        raise P.GateFailed(f"mart tests failed: {[(r.model, r.column_name, r.test) for r in failures]}")
    return names


# Partition column of the stored fact.  Size partitions to the data: a
# month of tickets is ~200 MB at 1000x the test data; once a single day
# holds gigabytes, partition by ``purchase_date`` instead (the merge and
# the table helpers take the column as a parameter).
FACT_PARTITION = "purchase_month"


def with_fact_partition(df: DataFrame) -> DataFrame:
    return df.withColumn(FACT_PARTITION, F.trunc("purchase_date", "month"))


def ensure_fact_table(spark: SparkSession, table: str) -> str:
    return S.ensure_table(spark, table, schemas.FACT_VISITS_STORED, (FACT_PARTITION,))


def merge_into_fact(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """D11 on the stored fact: update by ticket_id; only the months that hold
    or get a source ticket are rewritten."""
    P.merge_by_key(spark, table, with_fact_partition(rows), "ticket_id", partition_col=FACT_PARTITION)


def build_fact_visits(spark: SparkSession, sf_dir: str, purchase_date: str | dt.date,
                      fact_table: str, models: dict[str, DataFrame] | None = None) -> P.AuditResult:
    """P7 audit variant: audit one purchase day, test it, merge it into
    the stored fact (partitioned by ``FACT_PARTITION``) when the tests pass;
    a day that fails one leaves the fact as it was."""
    models = models or mart_models(spark, sf_dir)
    audit = M.audit_fact_visits(models["stg_haunted_house_tickets"],
                                models["stg_customer_feedbacks"], purchase_date)
    ensure_fact_table(spark, fact_table)
    parents = {"dim_customers": models["dim_customers"],
               "dim_haunted_houses": models["dim_haunted_houses"]}
    return P.write_audit_publish(
        spark, audit, AUDIT_CHECKS,
        publish=lambda rows: merge_into_fact(spark, fact_table, rows),
        audit_schema=schemas.FACT_VISITS, model="audit_fact_visits", parents=parents,
        require_rows=False)
