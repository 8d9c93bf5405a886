import contextlib
import datetime as dt
import io
from decimal import Decimal

from kestrel.operators import marts as M
from kestrel.operators import quality as Q
from kestrel.sources.seeds import valid_domains
from tests.conftest import rows

D = dt.date
TICKETS = ("ticket_id long, customer_id long, haunted_house_id long, purchase_date date, "
           "visit_date date, ticket_type string, ticket_price double")
FEEDBACKS = "feedback_id long, ticket_id long, rating long, comments string"


def test_dim_customers_email_flag(spark):
    c = spark.createDataFrame([(1, 30, "Male", "a@example.com"), (2, 30, None, "a@example.io"),
                               (3, 30, None, "a@other.org"), (4, 30, None, "example.com"),
                               (5, 30, None, None)],
                              "customer_id long, age long, gender string, email string")
    domains = valid_domains(spark)
    out = rows(M.dim_customers(c, domains), "customer_id", "is_valid_email_address")
    assert [v for _, v in out] == [True, True, False, False, False]


def test_dim_houses_conversion(spark):
    h = spark.createDataFrame([(1, "h", "p", "t", 2, 5)],
                              "haunted_house_id long, house_name string, park_area string, "
                              "theme string, fear_level int, house_size int")
    r = M.dim_houses(h).collect()[0]
    assert r.house_size_in_m2 == Decimal("1.52") and r.house_size_in_ft2 == 5


def test_fact_visits_left_join_fan_out(spark):
    t = spark.createDataFrame([(1, 1, 1, D(2024, 1, 1), None, "x", 10.0),
                               (2, 1, 1, D(2024, 1, 1), None, "x", 10.0)], TICKETS)
    f = spark.createDataFrame([(10, 2, 4, "a"), (11, 2, 5, "b")], FEEDBACKS)
    fact = M.fact_visits(t, f)
    out = rows(fact, "ticket_id", "rating")
    assert out == [(1, None), (2, 4), (2, 5)]
    dup = Q.unique(fact, "ticket_id").collect()
    assert [(r.unique_field, r.n_records) for r in dup] == [(2, 2)]


def test_values_of_the_fact_broadcast_neither_side(spark, tmp_path):
    """Tickets and feedbacks grow with the data; the keys of either look small as files."""
    import __spark_entry__ as E
    key = "CASE WHEN id % 97 = 0 THEN NULL ELSE id % 4000 END"     # null keys, and tickets that come twice
    spark.range(5000).selectExpr(
        f"{key} AS o_orderkey", "id AS o_custkey", "TIMESTAMP_NTZ'1996-01-01' AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", "1D AS o_totalprice").write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(6000).selectExpr(
        f"{key} AS l_orderkey", "CAST(id % 5 AS DOUBLE) AS l_quantity", "IF(id % 2 = 0, 'R', 'N') AS l_returnflag",
        "TIMESTAMP_NTZ'1996-02-01' AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    keys = lambda n: [(i, i % 4000) for i in range(n) if i % 97]
    quantity = {}
    for i, k in keys(6000):
        if i % 2 == 0:
            quantity[k] = quantity.get(k, 0) + i % 5
    df = E.queries()["dq_accepted_values"](spark, str(tmp_path))
    assert rows(df) == [("5", sum(quantity.get(k, 0) % 5 == 4 for _, k in keys(5000)))]
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    assert "SortMergeJoin" in buf.getvalue() and "Broadcast" not in buf.getvalue()


def test_audit_day_semi_join(spark):
    t = spark.createDataFrame([(1, 1, 1, D(2024, 11, 6), None, "x", 1.0),
                               (2, 1, 1, D(2024, 11, 5), None, "x", 1.0)], TICKETS)
    f = spark.createDataFrame([(10, 1, 3, "a"), (11, 2, 5, "b")], FEEDBACKS)
    out = M.audit_fact_visits(t, f, "2024-11-06").collect()
    assert [(r.ticket_id, r.rating) for r in out] == [(1, 3)]


def test_checks(spark):
    df = spark.createDataFrame([(1, 5, "a@b.co"), (2, None, "@b.co"), (3, 0, "a@@b.co"),
                                (None, -1, "a.@b.co"), (5, 7, "ab.co"), (6, 9, None)],
                               "id long, v long, email string")
    assert Q.not_null(df, "id").count() == 1
    assert Q.is_positive(df, "v").count() == 2                       # nulls pass
    assert rows(Q.accepted_values(df, "v", [5, 7, 9, 0, -1])) == []  # null v passes
    assert [r.email for r in Q.valid_email(df, "email").collect()] == \
        ["@b.co", "a@@b.co", "a.@b.co", "ab.co"]
    assert Q.valid_email(df, "email", literal=True).count() == 5      # every '@' address fails
    parent = df.sparkSession.createDataFrame([(1,), (2,)], "pid long")
    rel = Q.relationships(df, "id", parent, "pid")
    assert sorted(r.id for r in rel.collect()) == [3, 5, 6]          # null child key passes
    assert Q.not_null(df, "id", where="v > 0").count() == 0


def test_run_checks_counts_in_one_frame(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 0)], "id long, v long")
    res = {(r.column_name, r.test): (r.failures, r.status) for r in Q.run_checks("m", df, [
        Q.Check("not_null", "v"), Q.Check("unique", "id"), Q.Check("is_positive", "v"),
        Q.Check("accepted_values", "v", values=(5,), where="v IS NOT NULL")]).collect()}
    assert res == {("v", "not_null"): (1, "fail"), ("id", "unique"): (1, "fail"),
                   ("v", "is_positive"): (1, "fail"), ("v", "accepted_values"): (1, "fail")}


def test_day_counts_marks_empty_days(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 3),)], "ds date")
    out = rows(Q.day_counts(df, "2024-01-01", "2024-01-03"), "ds", "dq_check")
    assert [c for _, c in out] == ["pass", "fail", "pass"]


def test_seed_reports_the_lines_that_do_not_fit(spark, tmp_path):
    from pyspark.sql import types as T

    from kestrel.sources.seeds import read_seed
    (tmp_path / "seed.csv").write_text("domain,rank\nexample.com,1\nexample.io,two\na,2,3\nb\n\nlast.org,4\n")
    schema = T._parse_datatype_string("domain string, rank long")
    got = rows(read_seed(spark, str(tmp_path / "seed.csv"), schema))
    assert got == [("example.com", 1, None), ("last.org", 4, None), (None, None, "a,2,3"), (None, None, "b"),
                   (None, None, "example.io,two")]


def test_unit_difference_is_of_multisets(spark):
    schema = "k long, v string"
    actual = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], schema)
    expected = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (3, "d")], schema)
    assert rows(Q.unit_difference(actual, expected)) == [
        (1, "a", "unexpected", 1), (3, "c", "unexpected", 1), (3, "d", "missing", 2)]
    assert Q.unit_difference(actual, actual).isEmpty()


def test_unit_check_turns_red_for_one_wrong_flag(spark):
    from pyspark.sql import functions as F

    from kestrel.queries import dim_customers
    from tests.conftest import SF0001
    actual = dim_customers(spark, SF0001)
    wrong = actual.withColumn("is_valid_email_address", F.col("is_valid_email_address") != (F.col("customer_id") == 5))
    assert rows(Q.unit_result("t", actual, actual)) == [("t", 0, 0, "pass")]
    assert rows(Q.unit_result("t", wrong, actual)) == [("t", 1, 1, "fail")]


def test_positions_tell_a_report_without_its_sort(spark):
    from kestrel import queries as Qy
    from kestrel.operators import growth as G
    from kestrel.operators import retention as R
    from kestrel.sources import fixtures as fx
    from tests.conftest import SF0001
    for sorted_, plain in (
            (Qy.os_growth_mom_yoy(spark, SF0001), G.growth(Qy.os_monthly_active(spark, SF0001))),
            (Qy.retention_monthly(spark, SF0001), R.retention(fx.activity(spark, SF0001)))):
        assert rows(sorted_) == rows(plain)                  # the rows are the same
        assert rows(Q.with_position(sorted_)) != rows(Q.with_position(plain))
        places = sorted(r.position for r in Q.with_position(sorted_).collect())
        assert places == list(range(1, len(places) + 1))


def test_read_back_tells_what_staging_left(spark):
    from kestrel import schemas
    from kestrel.plans import storage as S
    table = S.ensure_table(spark, S.new_table_name("layout"), schemas.VALID_DOMAINS)
    S.insert_overwrite_table(spark, valid_domains(spark), table)
    before = rows(S.read_back(spark, table))
    assert before == [("column", "valid_domain", "string")]
    stage = S.stage(spark, valid_domains(spark), table)
    kinds = [r[0] for r in rows(S.read_back(spark, table))]
    assert kinds == ["column", "left behind", "left behind"]     # the staging table and its folder
    S.unstage(spark, stage)
    assert rows(S.read_back(spark, table)) == before
