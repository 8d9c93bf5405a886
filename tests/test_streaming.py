import datetime as dt
import shutil
from pathlib import Path

from pyspark.sql import functions as F

from kestrel.operators import bars as B
from kestrel.plans import storage as S
from kestrel.sources import fixtures as fx
from kestrel.sources import landed as L
from kestrel.streaming import landed_bars
from tests.conftest import SF0001, rows


def test_available_now_processes_each_landed_day_once(spark, tmp_path):
    raw = fx.stock_bars_raw(spark, SF0001)
    landing = L.land_api_responses(spark, raw, str(tmp_path / "landing"))
    prod, cum = S.new_table_name("prod"), S.new_table_name("cum")
    ckpt = str(tmp_path / "ckpt")
    q = landed_bars.start(spark, landing, prod, cum, checkpoint=ckpt)
    q.awaitTermination(600)
    assert q.exception() is None
    bars = L.ingest_bars(spark, landing)
    assert rows(spark.table(prod).select(*bars.columns)) == rows(bars)
    last = bars.agg(F.max("ds")).first()[0]
    first = bars.agg(F.min("ds")).first()[0]
    expect = B.last7_backfill(bars, first, last).filter(F.col("ds") == F.lit(last))
    got = spark.table(cum).filter(F.col("ds") == F.lit(last))
    assert rows(got, "stock_symbol", "last_7_prices") == rows(expect, "stock_symbol",
                                                              "last_7_prices")
    # a second run with the same checkpoint finds nothing new
    q2 = landed_bars.start(spark, landing, prod, cum, checkpoint=ckpt)
    q2.awaitTermination(600)
    assert spark.table(prod).count() == bars.count()


def test_a_day_split_over_batches_keeps_all_rows(spark, tmp_path):
    raw = fx.stock_bars_raw(spark, SF0001).where("ds <= date'2024-01-04'")
    first = L.land_api_responses(spark, raw.where("stock_symbol in ('error', 'purchase')"), str(tmp_path / "landing"))
    whole = L.land_api_responses(spark, raw, str(tmp_path / "whole"))
    prod, cum, ckpt = S.new_table_name("prod"), S.new_table_name("cum"), str(tmp_path / "ckpt")

    def run():
        q = landed_bars.start(spark, first, prod, cum, checkpoint=ckpt, max_files_per_trigger=1)
        q.awaitTermination(600)
        assert q.exception() is None

    run()
    # files that arrive later, for days that are already published
    late = str(tmp_path / "late")
    L.land_api_responses(spark, raw.where("stock_symbol not in ('error', 'purchase')"), late)
    for day in sorted(Path(late).glob("ds=*")):
        for file in day.glob("*.json"):
            shutil.copy(file, Path(first) / day.name / f"late-{file.name}")
    run()
    bars = L.ingest_bars(spark, whole)
    assert rows(spark.table(prod).select(*bars.columns)) == rows(bars)
    days = bars.agg(F.min("ds"), F.max("ds")).first()
    expect = B.last7_backfill(bars, *days)
    assert rows(spark.table(cum), "stock_symbol", "ds", "last_7_prices") == rows(expect, "stock_symbol", "ds", "last_7_prices")


def test_unusable_rows_go_to_the_dead_letters_and_the_stream_goes_on(spark, tmp_path):
    landing = tmp_path / "landing"
    line = '{"ticker": "%s", "status": "OK", "resultsCount": 1, "results": [{"t": %d, "o": 1, "h": 2, "l": 1, "c": %s, "v": 5, "n": 1}]}'
    day = 1704067200000                                          # 2024-01-01
    first = [line % ("a", day, 10), line % ("a", day + 5, 11), line % ("a", day, 10), line % ("b", day, -1),
             line % ("c", day, 3), '{"ticker": "d", "status": "OK", "resu', "no json at all",
             '{"status": "OK", "resultsCount": 1, "results": [{"t": 5, "c": 1}]}',
             '{"ticker": "e", "status": "OK", "resultsCount": 1, "results": "not a list"}',
             '{"ticker": "f", "status": "DELAYED"}', '{"ticker": "g", "status": "OK", "resultsCount": 0, "results": []}']
    for ds, name, lines in (("2024-01-01", "a.json", first), ("2024-01-02", "b.json", [line % ("a", day + 86400000, 12)])):
        (landing / f"ds={ds}").mkdir(parents=True)
        (landing / f"ds={ds}" / name).write_text("\n".join(lines))
    (landing / "ds=2024-01-02" / "broken.json").write_bytes(bytes(range(128, 256)) * 3 + b"\x00{{{[")
    prod, cum = S.new_table_name("prod"), S.new_table_name("cum")

    def run():
        q = landed_bars.start(spark, str(landing), prod, cum, checkpoint=str(tmp_path / "ckpt"), max_files_per_trigger=1)
        q.awaitTermination(600)
        assert q.exception() is None

    run()
    assert rows(spark.table(prod), "ds", "stock_symbol", "closing_price") == [
        (dt.date(2024, 1, 1), "a", 11.0), (dt.date(2024, 1, 1), "c", 3.0), (dt.date(2024, 1, 2), "a", 12.0)]
    letters = spark.table(f"{prod}_rejected")
    assert rows(letters.where("ds = '2024-01-01'"), "reason", "stock_symbol", "copies") == [
        (L.MALFORMED, None, 1)] * 3 + [("no symbol", None, 1), ("price not positive", "b", 1), (L.REPEATED, "a", 2)]
    assert "no json at all" in {r.record for r in letters.collect()}
    assert letters.where("ds = '2024-01-02'").agg(F.sum("copies")).first()[0] >= 1
    assert rows(spark.table(cum).where("ds = '2024-01-02'"), "stock_symbol", "last_7_prices") == [
        ("a", [11.0, 12.0]), ("c", [3.0])]
    # a replay of a batch replaces its letters
    for _ in range(2):
        landed_bars.process_batch(spark, L.read_landed(spark, str(landing), "2024-01-01"), prod, cum, run="replayed")
        assert spark.table(f"{prod}_rejected").where("run = 'replayed'").agg(F.sum("copies")).first()[0] == 7
    # files that come later are processed as ever
    (landing / "ds=2024-01-03").mkdir()
    (landing / "ds=2024-01-03" / "c.json").write_text(line % ("a", day + 2 * 86400000, 13))
    run()
    assert spark.table(prod).where("ds = '2024-01-03'").count() == 1
