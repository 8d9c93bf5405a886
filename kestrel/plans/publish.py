"""Write-audit-publish, idempotent partition publish, snapshot overwrite and merge.

Every publish writes its rows once, to a staging table below the target's
folder, and checks that copy; the target is then pointed at it
(``plans.storage``), so a failure anywhere before leaves the published rows and
running readers keep theirs.  Reruns with the same input leave the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators import quality as Q
from kestrel.plans import storage as S


class GateFailed(RuntimeError):
    """A publish was refused; the target is untouched."""


def gate_nonempty(df: DataFrame, ds: str | dt.date, ds_col: str = "ds") -> DataFrame:
    """One row, dq_check 'pass' / 'fail' for the staged day."""
    return Q.nonempty(df, ds, ds_col)


def _gate_passes(df: DataFrame, ds: str | dt.date, ds_col: str) -> bool:
    # a one-row aggregate: only 'pass'/'fail' reaches the driver
    return gate_nonempty(df, ds, ds_col).first()["dq_check"] == "pass"


def publish_partition(spark: SparkSession, staged: DataFrame, table: str, ds: str | dt.date,
                      ds_col: str = "ds", require_rows: bool = True) -> None:
    """Replace the ``ds`` partition of ``table`` with the staged day.

    The day is written once; the gate and the publish read that copy.  With
    ``require_rows`` an empty staged day raises ``GateFailed`` leaving the
    target untouched.
    """
    day = staged.filter(F.col(ds_col) == F.lit(str(ds)).cast("date"))
    with S.staged(spark, day, table) as stage:
        if require_rows and not _gate_passes(spark.table(stage), ds, ds_col):
            raise GateFailed(f"no staged rows for {ds_col}={ds}")
        S.replace_partition(spark, stage, table, {ds_col: str(ds)})


def overwrite_table(spark: SparkSession, df: DataFrame, table: str,
                    refuse: Callable[[DataFrame], str | None] | None = None) -> None:
    """Replace the whole table with ``df``; an empty batch is refused
    (it would otherwise publish an empty snapshot), as is one for whose
    staged copy ``refuse`` gives a reason.  The files of the snapshot before stay
    for its readers until ``storage.remove_retired`` finds them old enough."""
    with S.staged(spark, df, table) as stage:
        if spark.table(stage).isEmpty():
            raise GateFailed(f"refusing to overwrite {table} with an empty batch")
        if refuse and (reason := refuse(spark.table(stage))):
            raise GateFailed(reason)
        S.replace_table(spark, stage, table)


@dataclass
class AuditResult:
    passed: bool
    results: DataFrame          # (model, column_name, test, failures, status), cached locally
    audit_table: str


def _audited(spark: SparkSession, model: str, rows: DataFrame, checks: Sequence[Q.Check],
             parents: dict[str, DataFrame] | None, require_rows: bool) -> tuple[bool, DataFrame]:
    """Whether the written copy ``rows`` passes, and its results (one row per check)."""
    results = Q.run_checks(model, rows, checks, parents)
    if require_rows:
        n = rows.agg(F.count(F.lit(1)).alias("failures"))
        results = results.unionByName(n.select(
            F.lit(model).alias("model"), F.lit("*").alias("column_name"),
            F.lit("nonempty").alias("test"),
            (F.col("failures") == 0).cast("bigint").alias("failures"),
            F.when(F.col("failures") == 0, "fail").otherwise("pass").alias("status")))
    collected = results.collect()
    return all(r["status"] == "pass" for r in collected), spark.createDataFrame(collected, results.schema)


def write_audit_publish(spark: SparkSession, df: DataFrame, checks: Sequence[Q.Check],
                        publish: Callable[[DataFrame], None], audit_schema,
                        partition_cols: Sequence[str] = (), model: str = "audit",
                        parents: dict[str, DataFrame] | None = None,
                        require_rows: bool = True, keep_audit: bool = False) -> AuditResult:
    """P5: write ``df`` to an audit table, test the audit table, and call
    ``publish(audit_rows)`` only when every check passes.

    The checks read the written audit copy (the exact rows that would be
    published, and a cut in the lineage); ``publish`` gets the same copy,
    so nothing is recomputed between audit and publish.  On failure the
    target is untouched and the audit copy stays for inspection.
    """
    audit = S.new_table_name(f"{model}_audit")
    S.ensure_table(spark, audit, audit_schema, partition_cols)
    df.select(*S.table_columns(spark, audit)).write.insertInto(audit)
    rows = spark.table(audit)
    passed, results = _audited(spark, model, rows, checks, parents, require_rows)
    if passed:
        publish(rows)
        if not keep_audit:
            S.drop_table(spark, audit)
    return AuditResult(passed, results, audit)


def audit_partitions(spark: SparkSession, df: DataFrame, checks: Sequence[Q.Check], table: str,
                     model: str = "audit", parents: dict[str, DataFrame] | None = None,
                     require_rows: bool = True) -> AuditResult:
    """P5 where the publish replaces whole partitions: the audit copy is staged as the
    target stores it, tested there, and the target's partitions are pointed at it, so
    each row is written once.  On failure the target is untouched and the audit
    table stays for inspection (``storage.unstage`` ends it)."""
    audit = S.stage(spark, df, table)
    passed, results = _audited(spark, model, spark.table(audit), checks, parents, require_rows)
    if passed:
        S.publish_stage(spark, audit, table)
        S.unstage(spark, audit)
    return AuditResult(passed, results, audit)


def merge_by_key(spark: SparkSession, target: str, source: DataFrame, key: str,
                 partition_col: str | None = None, check_unique: bool = True) -> None:
    """Update target rows whose key is in ``source``, insert the rest.

    result = (target rows whose key is not in source) UNION ALL source,
    rewritten only for the touched partitions: those holding a source key in the
    target plus those the source writes to.  A key that changed its partition
    therefore leaves the old one; a null partition value is a partition like
    any other.

    The target is looked up once: the source is written to a staging table, its
    least and greatest key bound the scan of the target's key and partition
    columns (row groups outside are skipped), and the target keys found are written
    too (no more rows than the source).  Their partitions and the source's are the
    touched ones: names only, at most the table's partitions, which prune the one
    scan of whole rows.  The new contents are written once and the touched partitions
    pointed at them; those left without rows leave the catalog.  Without
    ``partition_col`` the whole table is rewritten the same way.

    ``check_unique`` refuses a source whose key repeats (a merge would
    otherwise be ambiguous).
    """
    tgt = spark.table(target)
    with S.staged(spark, source, target) as src_stage:
        src = spark.table(src_stage)
        if check_unique and not Q.unique(src, key).isEmpty():
            raise GateFailed(f"merge source has repeated {key} values")
        if partition_col is None:
            S.insert_overwrite_table(spark, tgt.join(src.select(key), key, "left_anti").unionByName(src), target)
            return
        with S.staged(spark, matched_rows(tgt, src, key, partition_col), target) as found_stage:
            found = spark.table(found_stage).select(key)
            touched = sorted({*S.partitions(spark, found_stage), *S.partitions(spark, src_stage)})
            known = in_partitions(tgt, partition_col, touched)
            new = known.join(found, key, "left_anti").unionByName(src)
            with S.staged(spark, new, target) as new_stage:
                S.publish_stage(spark, new_stage, target, touched)


def matched_rows(target: DataFrame, source: DataFrame, key: str, partition_col: str) -> DataFrame:
    """The key and partition of the target rows whose key the source holds; other columns null.

    Only these two columns are read, and only row groups that may hold a key between the
    source's least and greatest."""
    low, high = source.agg(F.min(key), F.max(key)).first()
    held = target.select(key, partition_col).where(F.col(key).between(F.lit(low), F.lit(high)))
    held = held.join(source.select(key), key, "left_semi")
    return held.select(*[F.col(c) if c in (key, partition_col) else F.lit(None).cast(target.schema[c].dataType).alias(c)
                         for c in target.columns])


def in_partitions(df: DataFrame, partition_col: str, names: Sequence[str]) -> DataFrame:
    """The rows of the named partitions (``column=value``), by a filter on the partition column."""
    values = [unquote(n.partition("=")[2]) for n in names]
    some = [F.lit(v).cast(df.schema[partition_col].dataType) for v in values if v != S.NULL_VALUE]
    held = F.col(partition_col).isin(some) if some else F.lit(False)
    return df.where(held | F.col(partition_col).isNull() if S.NULL_VALUE in values else held)
