"""Incremental daily bar job driven by file arrival (Structured Streaming).

The reference runs its bar pipeline once a day with catch-up: every day
that has not been processed is ingested, checked, published and folded
into the last-7 array, in date order.  The same contract as a stream:

* source: the landing folder of API responses (``ds=YYYY-MM-DD``
  sub-folders), read with a declared schema; the checkpoint records which
  files were consumed, so each landed file is processed once;
* ``trigger(availableNow=True)`` processes everything landed so far and
  stops (a scheduled run with catch-up); a processing-time trigger keeps
  it running;
* each micro-batch runs the daily job for the days it contains, oldest
  first; rows of a day that earlier batches published stay, and a late day
  is folded into the later arrays too.  Every write replaces a partition, so
  a batch replayed after a failure rewrites the same rows (at-least-once
  delivery, exactly-once table contents);
* a landed row that cannot be used (a line that is no response, no symbol or
  time, a price that is not positive, a symbol twice) goes to the dead letters
  beside the bar table and the stream goes on with the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kestrel import schemas
from kestrel.operators import bars as B
from kestrel.plans import jobs as J
from kestrel.plans import storage as S
from kestrel.session import checkpoint_dir
from kestrel.sources.landed import CORRUPT, LANDED_LINES, entries, sort_out


def process_batch(spark: SparkSession, batch: DataFrame, prod: str, cumulative: str,
                  keep: int = B.KEEP, run: str = "batch") -> list:
    """Run the daily job for each day present in a batch of landed responses.

    Only the batch's distinct load dates reach the driver (one row per
    day); all row work stays in Spark jobs.
    """
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    with S.scratch(spark, entries(batch), schemas.LANDED_ENTRY) as found:       # the batch, read once
        kept, rejected = sort_out(spark.table(found))
        J.reject(spark, rejected, prod, run)
        with S.staged(spark, kept, prod) as stage:
            bars = spark.table(stage)
            days = S.partition_dates(spark, stage)
            for ds in days:
                day = bars.filter(F.col("ds") == F.lit(ds))
                # a day may arrive in several batches: what is published stays,
                # except the symbols that this batch brings again
                held = spark.table(prod).filter(F.col("ds") == F.lit(ds)).join(
                    day.select("stock_symbol"), "stock_symbol", "left_anti")
                J.publish_bars_day(spark, day.unionByName(held.select(*day.columns)), ds, table=prod)
            for ds in days:
                J.cumulate_through(spark, prod, cumulative, ds, keep)
    return days


def default_checkpoint(spark: SparkSession, prod: str, cumulative: str) -> str:
    """Stable per target pair, so each scheduled run resumes where the last stopped."""
    name = f"{prod}__{cumulative}".replace(".", "_")
    return f"{checkpoint_dir(spark)}/kestrel-streams/{name}"


def start(spark: SparkSession, landing: str, prod: str, cumulative: str,
          checkpoint: str | None = None, available_now: bool = True,
          processing_time: str = "1 hour", max_files_per_trigger: int | None = None
          ) -> StreamingQuery:
    """Start the incremental job; returns the streaming query handle.

    ``checkpoint`` defaults to a stable folder (per target tables) under
    the shared checkpoint folder.
    """
    S.ensure_table(spark, prod, schemas.BARS, ("ds",))
    reader = spark.readStream.schema(LANDED_LINES).option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(landing)
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: process_batch(spark, df, prod, cumulative, run=f"batch-{epoch}"))
              .option("checkpointLocation", checkpoint or default_checkpoint(spark, prod, cumulative)))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()
