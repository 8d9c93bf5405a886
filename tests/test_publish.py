import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.plans import publish as P
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from tests.conftest import SF0001, rows

D = dt.date


def _bars(spark):
    return B.normalize_bars(fx.stock_bars_raw(spark, SF0001))


def test_publish_partition_is_idempotent(spark):
    bars = _bars(spark)
    table = S.new_table_name("prod")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    P.publish_partition(spark, bars, table, "2024-01-05")
    once = rows(spark.table(table))
    P.publish_partition(spark, bars, table, "2024-01-05")
    assert rows(spark.table(table)) == once and len(once) == 5


def test_empty_staged_day_leaves_target(spark):
    bars = _bars(spark)
    table = S.new_table_name("prod")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    P.publish_partition(spark, bars, table, "2024-01-05")
    before = rows(spark.table(table))
    assert P.gate_nonempty(bars, "2030-01-01").collect()[0].dq_check == "fail"
    with pytest.raises(P.GateFailed):
        P.publish_partition(spark, bars, table, "2030-01-01")
    assert rows(spark.table(table)) == before


def test_overwrite_refuses_empty_batch(spark):
    bars = _bars(spark).drop("ds")
    table = S.new_table_name("snap")
    S.ensure_table(spark, table, schemas.BARS_BY_DAY, ("created_at_day",))
    out = bars.withColumn("created_at_day", F.to_date("created_ts"))
    P.overwrite_table(spark, out, table)
    with pytest.raises(P.GateFailed):
        P.overwrite_table(spark, out.limit(0), table)
    assert spark.table(table).count() == 150


def test_merge_updates_inserts_keeps(spark):
    schema = "k long, v string, p date"
    table = S.new_table_name("merge_t")
    from pyspark.sql import types as T
    S.ensure_table(spark, table, T._parse_datatype_string(schema), ("p",))
    tgt = spark.createDataFrame([(1, "old", D(2024, 1, 1)), (2, "keep", D(2024, 1, 1)),
                                 (3, "keep", D(2024, 1, 2))], schema)
    S.insert_overwrite_dynamic(spark, tgt, table)
    src = spark.createDataFrame([(1, "new", D(2024, 1, 1)), (4, "ins", D(2024, 1, 3))], schema)
    P.merge_by_key(spark, table, src, "k", partition_col="p")
    assert rows(spark.table(table), "k", "v") == [(1, "new"), (2, "keep"), (3, "keep"), (4, "ins")]
    P.merge_by_key(spark, table, src, "k", partition_col="p")         # rerun: unchanged
    assert spark.table(table).count() == 4
    with pytest.raises(P.GateFailed):
        P.merge_by_key(spark, table, src.unionByName(src), "k", partition_col="p")


def test_write_audit_publish_gates(spark):
    from kestrel.operators import quality as Q
    bars = _bars(spark)
    table = S.new_table_name("prod")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    day = bars.filter(F.col("ds") == F.lit("2024-01-04"))
    ok = P.write_audit_publish(spark, day, [Q.Check("not_null", "stock_symbol")],
                               lambda r: P.publish_partition(spark, r, table, "2024-01-04"),
                               schemas.BARS, ("ds",), model="bars")
    assert ok.passed and spark.table(table).count() == 5
    failing = P.write_audit_publish(
        spark, day.withColumn("stock_symbol", F.lit(None).cast("string")),
        [Q.Check("not_null", "stock_symbol")],
        lambda r: P.publish_partition(spark, r, table, "2024-01-04"),
        schemas.BARS, ("ds",), model="bars")
    assert not failing.passed
    assert spark.table(table).filter("stock_symbol IS NULL").count() == 0


def test_merge_inserts_into_a_source_day(spark):
    from pyspark.sql import types as T
    schema = "k long, v string, p date"
    table = S.new_table_name("merge_s")
    S.ensure_table(spark, table, T._parse_datatype_string(schema), ("p",))
    tgt = spark.createDataFrame([(1, "old", D(2024, 1, 1)), (2, "keep", D(2024, 1, 2))], schema)
    S.insert_overwrite_dynamic(spark, tgt, table)
    src = spark.createDataFrame([(1, "new", D(2024, 1, 1)), (3, "ins", D(2024, 1, 1))], schema)
    P.merge_by_key(spark, table, src, "k", partition_col="p")
    assert rows(spark.table(table), "k", "v", "p") == [
        (1, "new", D(2024, 1, 1)), (2, "keep", D(2024, 1, 2)), (3, "ins", D(2024, 1, 1))]


def test_merge_moves_key_out_of_a_partition(spark):
    from pyspark.sql import types as T
    schema = "k long, v string, p date"
    table = S.new_table_name("merge_m")
    S.ensure_table(spark, table, T._parse_datatype_string(schema), ("p",))
    tgt = spark.createDataFrame([(1, "a", D(2024, 1, 1)), (2, "b", D(2024, 1, 2))], schema)
    S.insert_overwrite_dynamic(spark, tgt, table)
    src = spark.createDataFrame([(1, "moved", D(2024, 1, 3))], schema)
    P.merge_by_key(spark, table, src, "k", partition_col="p")
    assert rows(spark.table(table), "k", "v", "p") == [(1, "moved", D(2024, 1, 3)),
                                                       (2, "b", D(2024, 1, 2))]


def test_explicit_location_keeps_its_partitions(spark, tmp_path):
    """A later application that names the same folder finds its partitions."""
    bars = _bars(spark)
    table, folder = S.new_table_name("persist"), str(tmp_path / "t")
    S.ensure_table(spark, table, schemas.BARS, ("ds",), location=folder)
    S.insert_overwrite_dynamic(spark, bars, table)
    S.drop_table(spark, table)                     # a table of a given folder: files stay
    S.ensure_table(spark, table, schemas.BARS, ("ds",), location=folder)
    assert spark.table(table).count() == 150
    assert spark.table(table).filter(F.col("ds") == F.lit(D(2024, 1, 3))).count() == 5


def test_dropped_table_leaves_no_files(spark):
    import glob
    table = S.new_table_name("gone")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark), table)
    loc = [r for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect() if r[0] == "Location"][0][1]
    path = loc.replace("file:", "")
    assert glob.glob(f"{path}/**/ds=*/*.parquet", recursive=True)
    S.drop_table(spark, table)
    assert not spark.catalog.tableExists(table) and not glob.glob(f"{path}/**", recursive=True)


def _failing(df):
    """The same rows, but evaluating them raises."""
    return df.withColumn("trade_count", F.raise_error(F.lit("broken input")).cast("bigint"))


@pytest.mark.parametrize("write", [
    lambda s, df, t: P.publish_partition(s, df, t, "2024-01-05"),
    lambda s, df, t: P.overwrite_table(s, df, t),
    lambda s, df, t: S.insert_overwrite_table(s, df, t),
    lambda s, df, t: S.insert_overwrite_dynamic(s, df, t),
    lambda s, df, t: S.insert_overwrite_partition(s, df.drop("ds"), t, {"ds": "2024-01-05"}),
    lambda s, df, t: P.merge_by_key(s, t, df, "stock_symbol", partition_col="ds", check_unique=False),
])
def test_a_failed_write_leaves_the_published_rows(spark, write):
    from pyspark.errors import PySparkException
    bars = _bars(spark)
    table = S.new_table_name("prod")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, bars, table)
    before, tables = rows(spark.table(table)), len(spark.catalog.listTables())
    with pytest.raises(PySparkException, match="broken input"):
        write(spark, _failing(bars), table)
    assert rows(spark.table(table)) == before and len(before) == 150
    assert len(spark.catalog.listTables()) == tables          # no staging copy left


def test_overwrite_of_an_unpartitioned_table(spark):
    from pyspark.errors import PySparkException
    table = S.new_table_name("flat")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    S.ensure_table(spark, table, df.schema)
    S.insert_overwrite_table(spark, df, table)
    with pytest.raises(PySparkException):
        S.insert_overwrite_table(spark, df.withColumn("v", F.raise_error(F.lit("x")).cast("string")), table)
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]
    S.insert_overwrite_table(spark, spark.table(table).where("k = 2"), table)
    assert rows(spark.table(table)) == [(2, "b")]


def _files(spark, table):
    import glob
    return set(glob.glob(S.table_root(spark, table).removeprefix("file:") + "/**/*.parquet", recursive=True))


def test_a_publish_writes_each_row_once(spark):
    bars = _bars(spark).cache()
    table = S.new_table_name("once")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, bars, table)
    before = _files(spark, table)
    P.publish_partition(spark, bars, table, "2024-01-05")
    new = _files(spark, table) - before
    read = {r[0] for r in spark.table(table).where("ds = '2024-01-05'").select(F.input_file_name()).distinct().collect()}
    assert new == {f.replace("file://", "") for f in read}       # the published file is the staged one
    assert before < _files(spark, table)                         # and the old files are still there
    bars.unpersist()


def test_a_reader_opened_before_an_overwrite_finishes(spark):
    """Its files stay until the clean-up step, which spares what is young or in use."""
    bars = _bars(spark)
    for columns in (("ds",), ()):
        table = S.new_table_name("open")
        S.ensure_table(spark, table, schemas.BARS, columns)
        S.insert_overwrite_table(spark, bars, table)
        reader = spark.table(table).toLocalIterator()              # a job for each of its tasks
        read = [next(reader)]
        P.overwrite_table(spark, bars.where("ds = '2024-01-05'"), table)
        assert S.remove_retired(spark, table, dt.timedelta(hours=1)) == []
        assert len([*read, *reader]) == 150
        assert spark.table(table).count() == 5
        gone = S.remove_retired(spark, table, dt.timedelta(0))
        assert len(gone) == (30 if columns else 1)
        assert S.remove_retired(spark, table, dt.timedelta(0)) == []
        assert spark.table(table).count() == 5 and len(_files(spark, table)) >= 1
        S.drop_table(spark, table)


def test_a_staged_folder_that_was_never_published_goes(spark):
    table = S.new_table_name("left")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark), table)
    stage = S.stage(spark, _bars(spark).limit(3), table)
    S.drop_table(spark, stage)                                   # as after a crash: the folder stays
    assert S.remove_retired(spark, table, dt.timedelta(hours=1)) == []
    assert len(S.remove_retired(spark, table, dt.timedelta(0))) == 1
    assert spark.table(table).count() == 150


def test_a_named_folder_gives_its_last_published_rows(spark, tmp_path):
    bars = _bars(spark)
    table, folder = S.new_table_name("again"), str(tmp_path / "t")
    S.ensure_table(spark, table, schemas.BARS, ("ds",), location=folder)
    S.insert_overwrite_dynamic(spark, bars, table)
    S.insert_overwrite_partition(spark, bars.where("ds = '2024-01-05'").limit(2).drop("ds"), table, {"ds": "2024-01-05"})
    S.insert_overwrite_partition(spark, bars.limit(0).drop("ds"), table, {"ds": "2024-01-06"})
    S.stage(spark, bars.limit(1), table)                         # not published
    before = rows(spark.table(table))
    S.drop_table(spark, table)
    S.ensure_table(spark, table, schemas.BARS, ("ds",), location=folder)
    assert rows(spark.table(table)) == before and len(before) == 142
    flat = str(tmp_path / "flat")
    S.ensure_table(spark, f"{table}_flat", schemas.BARS, location=flat)
    for n in (5, 3):
        S.insert_overwrite_table(spark, bars.limit(n), f"{table}_flat")
    S.drop_table(spark, f"{table}_flat")
    S.ensure_table(spark, f"{table}_flat", schemas.BARS, location=flat)
    assert spark.table(f"{table}_flat").count() == 3


def test_partition_values_with_odd_characters(spark):
    from pyspark.sql import types as T
    table = S.new_table_name("odd")
    S.ensure_table(spark, table, T._parse_datatype_string("k long, p string"), ("p",))
    values = ["a/b", "c=d", "it's", "100%", "x y", "back\\slash", None]
    df = spark.createDataFrame(list(enumerate(values)), "k long, p string")
    S.insert_overwrite_dynamic(spark, df, table)
    S.insert_overwrite_dynamic(spark, df.withColumn("k", F.col("k") + 10), table)
    assert rows(spark.table(table), "k", "p") == [(10 + k, v) for k, v in enumerate(values)]
    S.insert_overwrite_table(spark, df.where("k = 1"), table)
    assert rows(spark.table(table), "k", "p") == [(1, "c=d")]


def test_merge_reads_keys_once_and_touched_partitions_once(spark):
    """Scans of the target: its key columns in the look-up, whole rows of the touched month."""
    import contextlib
    import io
    from pyspark.sql import types as T
    table = S.new_table_name("scan")
    schema = "k long, v string, p date"
    S.ensure_table(spark, table, T._parse_datatype_string(schema), ("p",))
    S.insert_overwrite_dynamic(spark, spark.createDataFrame(
        [(k, "x", D(2024, 1, 1 + k % 3)) for k in range(90)], schema), table)
    src = spark.createDataFrame([(4, "new", D(2024, 1, 2)), (7, "new", D(2024, 1, 2))], schema)

    def plan(df):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        return buf.getvalue()
    look_up = plan(P.matched_rows(spark.table(table), src, "k", "p"))
    assert "ReadSchema: struct<k:bigint>" in look_up and "GreaterThanOrEqual(k,4), LessThanOrEqual(k,7)" in look_up
    whole = plan(P.in_partitions(spark.table(table), "p", ["p=2024-01-02", f"p={S.NULL_VALUE}"]))
    assert "PartitionFilters" in whole and "2024-01-02" in whole
    found = {r.p for r in P.matched_rows(spark.table(table), src, "k", "p").collect()}
    assert found == {D(2024, 1, 2)}


def test_merge_null_partition_moves_and_inserts(spark):
    from pyspark.sql import types as T
    schema = "k long, v string, p date"
    table = S.new_table_name("merge_n")
    S.ensure_table(spark, table, T._parse_datatype_string(schema), ("p",))
    S.insert_overwrite_dynamic(spark, spark.createDataFrame(
        [(1, "a", D(2024, 1, 1)), (2, "b", None), (3, "c", None), (5, "e", D(2024, 2, 1)), (6, "f", D(2024, 3, 1))], schema), table)
    src = spark.createDataFrame([(2, "b2", None), (4, "new", None), (5, "moved", D(2024, 1, 1))], schema)
    P.merge_by_key(spark, table, src, "k", partition_col="p")
    assert rows(spark.table(table), "k", "v", "p") == [
        (1, "a", D(2024, 1, 1)), (2, "b2", None), (3, "c", None), (4, "new", None), (5, "moved", D(2024, 1, 1)), (6, "f", D(2024, 3, 1))]
    src = spark.createDataFrame([(k, "dated", D(2024, 1, 9)) for k in (2, 3, 4)], schema)
    P.merge_by_key(spark, table, src, "k", partition_col="p")         # the null partition ends empty
    assert rows(spark.table(table).where("p IS NULL")) == [] and spark.table(table).count() == 6


def test_writes_leave_the_session_mode_alone(spark):
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode", None)
    table = S.new_table_name("mode")
    S.ensure_table(spark, table, schemas.BARS, ("ds",))
    S.insert_overwrite_dynamic(spark, _bars(spark), table)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode", None) == mode


def test_literals():
    assert S._literal(None) == "NULL" and S._literal(D(2024, 1, 2)) == "DATE '2024-01-02'"
    assert S._literal(dt.datetime(2024, 1, 2, 3, 4)) == "TIMESTAMP_NTZ '2024-01-02 03:04:00'"
    assert S._literal("a'b\\c") == "'a\\'b\\\\c'"
