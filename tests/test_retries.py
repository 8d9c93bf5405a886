"""Results after a task that fails and runs again on rows in another order."""

import subprocess
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = """
import random, sys, tempfile
from collections import Counter
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Window, functions as F
from kestrel.operators import olap as O, sessions as SS
from kestrel.session import get_session
from kestrel.sources import fixtures as fx

scratch = sys.argv[1]
spark = get_session("local[4,3]", shuffle_partitions=6, extra={
    "spark.checkpoint.dir": f"{scratch}/shared", "spark.sql.warehouse.dir": f"{scratch}/warehouse"})
spark.sparkContext.setLogLevel("OFF")
sf = "/root/testdata/sf0.001"
mapped = O.map_dims(fx.web_events(spark, sf), fx.devices(spark, sf)).select("user_id", "event_date", "event_time")
equal = mapped.limit(40).crossJoin(spark.range(25)).drop("id")          # equal events of one user and time
mapped = mapped.unionByName(equal).repartition(5)
failed = spark.sparkContext.accumulator(0)


def flaky(parts):
    # another order of rows in every attempt, and the first one fails half way
    task = TaskContext.get()
    rows = pd.concat(list(parts)).sample(frac=1, random_state=task.taskAttemptId() % 1000)
    half = len(rows) // 2
    yield rows.iloc[:half]
    if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
        raise RuntimeError("lost")
    yield rows.iloc[half:]


shaken = mapped.mapInPandas(flaky, mapped.schema)
w = Window.partitionBy("user_id", "event_date").orderBy("event_time").rowsBetween(Window.unboundedPreceding, 0)
plain = mapped.select("user_id", "event_time", F.min("event_time").over(w).alias("first_action_on_date"),
                      F.col("event_time").alias("last_action_on_date"), F.count("event_time").over(w).alias("n"))
got = SS.running_windows(shaken)
# and a failure behind the ranges: the join back and the windows run again
again = got.mapInPandas(flaky, got.schema)
want = Counter(map(tuple, plain.collect()))
assert sum(want.values()) > 1000
assert Counter(map(tuple, got.collect())) == want
assert Counter(map(tuple, again.collect())) == want
print("same")
"""


def test_running_frame_after_failed_tasks():
    with tempfile.TemporaryDirectory(prefix="kestrel-retry-") as scratch:
        done = subprocess.run([sys.executable, "-c", SCRIPT, scratch], cwd=ROOT, capture_output=True,
                              text=True, timeout=600)
    assert done.returncode == 0 and "same" in done.stdout, done.stderr[-3000:]
