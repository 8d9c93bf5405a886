"""Helpers shared by the training-data operators.

Intermediate tables and files lie under the folder that the session names
in ``spark.checkpoint.dir``, which all executors share.  Only where that is
unset *and* the master is one local JVM (tests) is a scratch folder made;
on a cluster its absence is an error.
"""

from __future__ import annotations

import ctypes
import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

# words are separated by these six ASCII characters and nothing else
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


_WORKSPACES: list[str] = []


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder in which all folders of :func:`work_dir` lie meanwhile, deleted at the end: for jobs
    whose result is written elsewhere."""
    path = work_dir(spark, name)
    _WORKSPACES.append(path)
    try:
        yield path
    finally:
        _WORKSPACES.remove(path)
        delete(spark, path)


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, fully qualified folder for one run, in the shared folder."""
    base = _WORKSPACES[-1] if _WORKSPACES else spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="kestrel-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/kestrel-llm/{name}-{uuid.uuid4().hex[:12]}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    return fs.makeQualified(path).toString()


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores behind those that a table's columns have already."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


ROWS_PER_FILE = 10_000


def stored(df: DataFrame, path: str, files: int | None = None, rows: int | None = None,
           compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet and return it as read back: cuts the lineage,
    and lost executors cost a re-read instead of a recomputation.

    ``files``: for tables of a row per task or source, so that each does not
    get a file.  ``rows``: about how many rows the tasks of the last stage work
    on; it runs as no more tasks than one for each ``ROWS_PER_FILE`` of them."""
    if files:
        df = df.repartition(files)
    elif rows is not None:
        df = df.coalesce(1 + rows // ROWS_PER_FILE)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release() -> None:
    """At the end of a task: give memory that was freed back to the system, since
    the Python worker lives on beside the executor's other processes."""
    pa.default_memory_pool().release_unused()
    if sys.platform.startswith("linux") and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a qualified URI, usable in tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def open_out(uri: str):
    fs, path = filesystem(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        os.makedirs(os.path.dirname(path), exist_ok=True)
    return fs.open_output_stream(path, compression=None)   # bytes as given, whatever the name


def open_in(uri: str):
    fs, path = filesystem(uri)
    return fs.open_input_file(path)
