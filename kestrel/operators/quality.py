"""Data tests as Spark checks.

A check returns the failing rows; zero rows means pass.  ``where`` is
the test-level row filter (a SQL predicate string or a Column) applied
before the test.  ``run_checks`` evaluates all row-level checks of one
table in a single aggregate pass (one scan), and the grouped checks
(unique, relationships) in one pass each; only the failure counts come
back to the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from dataclasses import field as dc_field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.email import invalid_email


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


def not_null(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Rows where ``column`` is null."""
    return _where(df, where).filter(F.col(column).isNull())


def unique(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Non-null values that occur more than once: (unique_field, n_records).

    A grouped count (partial aggregate): a value held by a large share of
    the rows is combined map-side and comes out as one row.
    """
    return (_where(df, where).filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values: Sequence, where: str | Column | None = None,
                    quote: bool = True) -> DataFrame:
    """Values outside ``values`` with their counts: (value_field, n_records).

    Nulls pass (``NOT IN`` on null is not true).  ``quote=True`` compares as
    strings, as a quoted value list does.
    """
    c = F.col(column).cast("string") if quote else F.col(column)
    vals = [str(v) for v in values] if quote else list(values)
    return (_where(df, where).filter(~c.isin(*vals))
            .groupBy(c.alias("value_field")).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str,
                  where: str | Column | None = None) -> DataFrame:
    """T4: rows whose non-null ``column`` has no match in ``parent.field``.

    A left-anti join against the distinct parent keys (the planner
    broadcasts them only when they measure small).
    """
    keys = parent.select(F.col(field).alias("_parent_key")).dropDuplicates()
    child = _where(df, where).filter(F.col(column).isNotNull())
    return child.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def is_positive(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """T5: rows where ``column <= 0`` (nulls pass): (positive_field)."""
    return (_where(df, where).filter(F.col(column) <= 0)
            .select(F.col(column).alias("positive_field")))


def valid_email(df: DataFrame, column: str, where: str | Column | None = None,
                literal: bool = False) -> DataFrame:
    """Addresses that fail the shape rules: (email).  ``literal=True``
    uses the reference's rule list as written (fails every address with
    an '@')."""
    return (_where(df, where).filter(invalid_email(column, literal))
            .select(F.col(column).alias("email")))


def nonempty(df: DataFrame, ds: str | dt.date, ds_col: str = "ds") -> DataFrame:
    """T7 / P2 gate: one row, ``dq_check`` = 'fail' when the day has no
    rows, else 'pass'.  The day filter is on the bare partition column, so
    it prunes partitions."""
    day = _where(df, F.col(ds_col) == F.lit(str(ds)).cast("date"))
    return day.agg(F.when(F.count(F.lit(1)) == 0, "fail").otherwise("pass").alias("dq_check"))


def day_counts(df: DataFrame, start: str | dt.date, end: str | dt.date,
               ds_col: str = "ds") -> DataFrame:
    """T7 over a date range: (ds, row_count, dq_check) for every day,
    days without rows included."""
    lo, hi = F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date")
    counts = (df.filter((F.col(ds_col) >= lo) & (F.col(ds_col) <= hi))
                .groupBy(F.col(ds_col).alias("ds")).agg(F.count(F.lit(1)).alias("row_count")))
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(lo, hi)).alias("ds"))
    j = spine.join(counts, "ds", "left")
    n = F.coalesce(F.col("row_count"), F.lit(0))
    return j.select("ds", n.alias("row_count"),
                    F.when(n == 0, "fail").otherwise("pass").alias("dq_check"))


def unit_difference(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """The rows in which a model's output differs from the expected rows, as multisets:
    its columns, ``side`` ('unexpected' or 'missing') and ``copies``.  Zero rows is a pass.

    Both sides are counted by row in one grouped pass (map-side first), so it works on
    tables of any size, and a row that is repeated without end is one row of each task."""
    columns = expected.columns
    both = actual.select(*columns, F.lit(1).alias("_n")).unionByName(expected.select(*columns, F.lit(-1).alias("_n")))
    n = F.col("_n")
    return (both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where(n != 0)
            .select(*columns, F.when(n > 0, "unexpected").otherwise("missing").alias("side"),
                    F.abs(n).cast("bigint").alias("copies")))


def unit_result(test: str, actual: DataFrame, expected: DataFrame) -> DataFrame:
    """:func:`unit_difference` as one row: test, missing, unexpected, status."""
    count = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0)).cast("bigint").alias(side)
    out = unit_difference(actual, expected).agg(count("missing"), count("unexpected"))
    return out.select(F.lit(test).alias("test"), "missing", "unexpected",
                      F.when(F.col("missing") + F.col("unexpected") == 0, "pass").otherwise("fail").alias("status"))


def with_position(report: DataFrame) -> DataFrame:
    """A sorted report with the place of each row (``position``, from 1), so that its order
    can be tested.  For reports: the rows are numbered by one task."""
    numbered = report.withColumn("_at", F.monotonically_increasing_id())
    return numbered.withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("bigint")).drop("_at")


# ---------------------------------------------------------------------------
# declared checks, evaluated together
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    test: str                       # not_null | unique | accepted_values | relationships | is_positive | valid_email
    column: str
    where: str | None = None
    values: tuple = ()
    parent: str | None = None       # name of the parent model (relationships)
    field: str | None = None
    options: dict = dc_field(default_factory=dict, hash=False, compare=False)


ROW_TESTS = ("not_null", "accepted_values", "is_positive", "valid_email")


def _row_failure(check: Check) -> Column:
    c = F.col(check.column)
    if check.test == "not_null":
        cond = c.isNull()
    elif check.test == "accepted_values":
        cond = ~c.cast("string").isin(*[str(v) for v in check.values])
    elif check.test == "is_positive":
        cond = c <= 0
    elif check.test == "valid_email":
        cond = invalid_email(check.column, check.options.get("literal", False))
    else:
        raise ValueError(check.test)
    if check.where:
        cond = F.expr(check.where) & cond
    return F.coalesce(cond, F.lit(False))


def run_checks(model: str, df: DataFrame, checks: Iterable[Check],
               parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Failure counts of every check on one model:
    (model, column_name, test, failures, status).

    One pass over the model answers the row-level checks and the first
    ``unique`` check: conditional counts per key, combined map-side, and their
    sums.  Further unique checks and relationships add one grouped pass each.
    The result is a small frame; nothing else reaches the driver.
    """
    checks = list(checks)
    spark = df.sparkSession
    parts: list[DataFrame] = []
    row_checks = [c for c in checks if c.test in ROW_TESTS]
    key = next((c for c in checks if c.test == "unique"), None)
    counts = [F.count(F.when(_row_failure(c), F.lit(1))).alias(f"_c{i}") for i, c in enumerate(row_checks)]
    one_pass = list(row_checks)
    if key:
        held = F.expr(key.where) if key.where else F.lit(True)
        per_key = df.groupBy(F.col(key.column).alias("_key")).agg(F.count(F.when(held, F.lit(1))).alias("_n"), *counts)
        one_pass.append(key)
        agg = per_key.agg(*[F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(row_checks))],
                          F.count(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.lit(1))).alias(f"_c{len(row_checks)}"))
    elif counts:
        agg = df.agg(*counts)
    if one_pass:
        stack = ", ".join(f"'{c.column}', '{c.test}', _c{i}" for i, c in enumerate(one_pass))
        parts.append(agg.selectExpr(f"stack({len(one_pass)}, {stack}) as (column_name, test, failures)"))
    for c in checks:
        if c is key:
            continue
        if c.test == "unique":
            n = unique(df, c.column, c.where).agg(F.count(F.lit(1)).alias("failures"))
        elif c.test == "relationships":
            if not parents or c.parent not in parents:
                raise ValueError(f"parent model {c.parent!r} not given")
            n = (relationships(df, c.column, parents[c.parent], c.field, c.where)
                 .agg(F.count(F.lit(1)).alias("failures")))
        else:
            continue
        parts.append(n.select(F.lit(c.column).alias("column_name"), F.lit(c.test).alias("test"),
                              "failures"))
    if not parts:
        return spark.createDataFrame([], "model string, column_name string, test string, "
                                         "failures long, status string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(model).alias("model"), "column_name", "test",
                      F.col("failures").cast("bigint").alias("failures"),
                      F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status"))
