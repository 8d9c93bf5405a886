"""Catalog tables on parquet: create, publish by pointer, level reads.

A table has a folder of its own.  Rows are written once, into a new version
folder below it (``_versions/v<time>-<id>``), through a staging table that
gates and tests read.  A publish then points the table's partitions (or the
table, if it has none) at the staged folders: ``ADD PARTITION`` /
``PARTITION ... SET LOCATION``, statements on the catalog alone.  So a failing
job leaves the target as it was, a reader sees a partition's old rows or its
new ones and never a mix, and a query that began before a publish finishes on
the files it began with: folders that nothing points at are deleted by
:func:`remove_retired`, a step of its own, once they are older than a stated age.

A version folder says itself what it published (``_PUBLISHED``, with the
partitions that the publish emptied), so an application that names a folder
again finds its last published rows.  Partitions of one publish are switched one
after another; a rerun ends a publish that was cut short.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
import urllib.parse
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed sentinel for the grand-total level ('' cannot be a partition value)
TOTAL_LEVEL = "grand_total"

VERSIONS, PUBLISHED = "_versions", "_PUBLISHED"
NULL_VALUE = "__HIVE_DEFAULT_PARTITION__"      # fixed: how a null partition value is written

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def new_table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _ident(name: str) -> str:
    parts = name.split(".")
    if not all(_NAME.match(p) for p in parts):
        raise ValueError(f"bad table name {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# --- folders -----------------------------------------------------------------

def _path(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(folder)


def _fs(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, whether it is a folder) of what lies in a folder, if it exists."""
    fs, path = _fs(spark, folder), _path(spark, folder)
    return sorted((f.getPath().getName(), f.isDirectory()) for f in fs.listStatus(path)) if fs.exists(path) else []


def _delete(spark: SparkSession, folder: str) -> None:
    _fs(spark, folder).delete(_path(spark, folder), True)


def _default_folder(spark: SparkSession, name: str) -> str:
    *db, table = name.split(".")
    return f"{spark.catalog.getDatabase(db[0] if db else spark.catalog.currentDatabase()).locationUri}/{table}"


# --- tables ------------------------------------------------------------------

def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_cols: Sequence[str] = (), location: str | None = None,
                 bucket_by: Sequence[str] = (), buckets: int = 0) -> str:
    """``CREATE TABLE IF NOT EXISTS`` a parquet table; returns its name.

    Partition columns go last in a partitioned table's schema, as Spark
    stores them.  Without ``location`` the table's folder is its place in the
    database and :func:`drop_table` deletes it.  A ``location`` is the
    caller's explicit choice of a folder; what was published there is found
    again.  ``bucket_by`` / ``buckets`` store each partition hash-bucketed by
    those columns, so a later join or aggregate on them reads the table
    already partitioned and does not shuffle it.
    """
    if spark.catalog.tableExists(name):
        return name
    fields = [f for f in schema.fields if f.name not in partition_cols]
    fields += [schema[c] for c in partition_cols]
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    bucket = (f" CLUSTERED BY ({', '.join(f'`{c}`' for c in bucket_by)}) INTO {buckets} BUCKETS"
              if bucket_by and buckets > 0 else "")
    root = (location or _default_folder(spark, name)).rstrip("/")
    held = published(spark, root, len(partition_cols))
    # an unpartitioned table points at its last version itself
    place = held.get("", root) if not partition_cols else root
    layout = Layout(root, location is None, tuple(partition_cols), tuple(bucket_by) if bucket else (), buckets if bucket else 0)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_ident(name)} ({ddl(T.StructType(fields))}) USING parquet{part}{bucket} "
              f"LOCATION {_quoted(place)} TBLPROPERTIES ('kestrel.layout' = {_quoted(json.dumps(asdict(layout)))})")
    if partition_cols and held:
        _add_partitions(spark, name, held)
    return name


@dataclass(frozen=True)
class Layout:
    """How a table is stored: ``root`` holds all its versions; ``owned``: and goes with it."""

    root: str
    owned: bool
    partitions: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0


def layout(spark: SparkSession, table: str) -> Layout:
    """The layout noted in the table's properties; of a table made elsewhere, what the catalog says."""
    noted = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_ident(table)}").collect()}
    if "kestrel.layout" in noted:
        held = json.loads(noted["kestrel.layout"])
        return Layout(held["root"], held["owned"], tuple(held["partitions"]), tuple(held["bucket_by"]), held["buckets"])
    columns, said = spark.catalog.listColumns(table), _described(spark, table)
    return Layout(said["Location"], False, tuple(c.name for c in columns if c.isPartition),
                  tuple(c.name for c in columns if c.isBucket), int(said.get("Num Buckets", 0)))


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """The detail lines of a table, or of one of its partitions."""
    return {r["col_name"]: r["data_type"]
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_ident(table)}{partition}").collect()}


def table_root(spark: SparkSession, table: str) -> str:
    """The folder that holds all versions of a table."""
    return layout(spark, table).root


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (the staging copy after a publish); the
    folder goes too, unless the caller chose it."""
    if not spark.catalog.tableExists(name):
        return
    held = layout(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")
    if held.owned:
        _delete(spark, held.root)


def table_columns(spark: SparkSession, name: str) -> list[str]:
    return spark.table(name).columns


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return list(layout(spark, table).partitions)


def partitions(spark: SparkSession, table: str) -> list[str]:
    """The partitions (``ds=2024-01-05/...``) of a table, from the catalog alone."""
    return [r[0] for r in spark.sql(f"SHOW PARTITIONS {_ident(table)}").collect()]


def partition_dates(spark: SparkSession, table: str) -> list[dt.date]:
    """The days of a table partitioned by one date, from the catalog alone."""
    values = [p.partition("=")[2] for p in partitions(spark, table)]
    return sorted(dt.date.fromisoformat(v) for v in values if v != NULL_VALUE)


def _spec(partition: str) -> str:
    """``PARTITION (...)`` of a catalog name such as ``ds=2024-01-05/level=a``."""
    pairs = (p.split("=", 1) for p in partition.split("/"))
    values = ((urllib.parse.unquote(k), urllib.parse.unquote(v)) for k, v in pairs)
    return "PARTITION (" + ", ".join(f"`{k}` = {'NULL' if v == NULL_VALUE else _quoted(v)}" for k, v in values) + ")"


def partition_name(values: dict[str, object]) -> str:
    """The catalog name of a partition whose values need no escape (dates, numbers, words)."""
    return "/".join(f"{k}={NULL_VALUE if v is None else v}" for k, v in values.items())


# --- staging -------------------------------------------------------------------

def _dealt(df: DataFrame, layout: Layout, aligned: bool) -> DataFrame:
    """Deal rows to write tasks as the table stores them.

    Bucketed: a task writes one bucket, so a bucket of a partition is one
    file; ``aligned`` rows already come a bucket to a task and are not moved.
    Else ``REBALANCE`` by the partition columns lets AQE pick the tasks:
    small table partitions are coalesced into one task (one file each instead
    of one per input task), and a table partition holding a large share of
    the rows is split over several tasks instead of landing in one.
    """
    if layout.buckets:
        return df if aligned else df.repartition(layout.buckets, *layout.bucket_by)
    return df.hint("rebalance", *layout.partitions) if layout.partitions else df


def stage(spark: SparkSession, df: DataFrame, table: str, aligned: bool = False) -> str:
    """Write ``df`` once, into a new version folder of ``table``; returns the staging
    table that reads it, with the columns, partitions and buckets of ``table``.

    A failure leaves nothing behind and every other table as it was.  The
    staging table ends with :func:`unstage`.
    """
    name, schema, held = new_table_name("stage"), spark.table(table).schema, layout(spark, table)
    folder = f"{held.root}/{VERSIONS}/v{int(time.time() * 1000):013d}-{uuid.uuid4().hex[:10]}"
    ensure_table(spark, name, schema, held.partitions, location=folder,
                 bucket_by=held.bucket_by, buckets=held.buckets)
    try:
        _dealt(df.select(*schema.fieldNames()), held, aligned).write.insertInto(name)
    except BaseException:
        unstage(spark, name)
        raise
    return name


def unstage(spark: SparkSession, name: str) -> None:
    """Drop a staging table, and its folder unless that was published."""
    folder = table_root(spark, name)
    spark.sql(f"DROP TABLE {_ident(name)}")
    if not _fs(spark, folder).exists(_path(spark, f"{folder}/{PUBLISHED}")):
        _delete(spark, folder)


@contextmanager
def staged(spark: SparkSession, df: DataFrame, table: str, aligned: bool = False) -> Iterator[str]:
    """The staging table of ``df`` for ``table``: ``df`` is evaluated once, here, and gates,
    tests and the publish all use that copy."""
    name = stage(spark, df, table, aligned)
    try:
        yield name
    finally:
        unstage(spark, name)


@contextmanager
def scratch(spark: SparkSession, df: DataFrame, schema: T.StructType) -> Iterator[str]:
    """A table of its own for ``df``, written once and dropped at the end."""
    name = ensure_table(spark, new_table_name("scratch"), schema)
    try:
        df.select(*schema.fieldNames()).write.insertInto(name)
        yield name
    finally:
        drop_table(spark, name)


# --- publish -------------------------------------------------------------------

def _add_partitions(spark: SparkSession, table: str, folders: dict[str, str]) -> None:
    if folders:
        listed = " ".join(f"{_spec(p)} LOCATION {_quoted(f)}" for p, f in folders.items())
        spark.sql(f"ALTER TABLE {_ident(table)} ADD IF NOT EXISTS {listed}")


def _drop_partitions(spark: SparkSession, table: str, names: Sequence[str]) -> None:
    """Take partitions out of the catalog; their files stay until they are removed."""
    if names:
        spark.sql(f"ALTER TABLE {_ident(table)} DROP IF EXISTS {', '.join(map(_spec, names))}")


def publish_stage(spark: SparkSession, stage: str, table: str, covers: Iterable[str] = ()) -> None:
    """Point the partitions of ``stage`` (of an unpartitioned table: the table) at the
    staged files, and drop those partitions of ``covers`` that the stage lacks."""
    held = layout(spark, stage)                  # the same partitions as the table's
    folder = held.root
    if not held.partitions:
        _mark(spark, folder, [])
        spark.sql(f"ALTER TABLE {_ident(table)} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(table)
        return
    new, held = partitions(spark, stage), set(partitions(spark, table))
    emptied = sorted(held.intersection(covers) - set(new))
    _mark(spark, folder, emptied)
    _add_partitions(spark, table, {p: f"{folder}/{p}" for p in new if p not in held})
    for p in new:
        if p in held:
            spark.sql(f"ALTER TABLE {_ident(table)} {_spec(p)} SET LOCATION {_quoted(f'{folder}/{p}')}")
    _drop_partitions(spark, table, emptied)
    spark.catalog.refreshTable(table)


def _mark(spark: SparkSession, folder: str, emptied: Sequence[str]) -> None:
    out = _fs(spark, folder).create(_path(spark, f"{folder}/{PUBLISHED}"), True)
    try:
        out.write(bytearray(json.dumps({"at": time.time(), "emptied": list(emptied)}).encode()))
    finally:
        out.close()


def _marks(spark: SparkSession, root: str) -> list[tuple[str, dict | None]]:
    """The version folders of a root and what they published (None: nothing), in order of publish."""
    out = []
    for version, is_folder in _listed(spark, f"{root}/{VERSIONS}"):
        folder = f"{root}/{VERSIONS}/{version}"
        mark = None
        if is_folder and (PUBLISHED, False) in _listed(spark, folder):
            stream = _fs(spark, folder).open(_path(spark, f"{folder}/{PUBLISHED}"))
            try:
                mark = json.loads(bytes(stream.readAllBytes()))
            finally:
                stream.close()
        if is_folder:
            out.append((folder, mark))
    return sorted(out, key=lambda v: (v[1] is None, v[1]["at"] if v[1] else 0.0, v[0]))


def _partition_folders(spark: SparkSession, folder: str, depth: int) -> dict[str, str]:
    """Partition name -> folder below ``folder``; an unpartitioned table's is ``folder`` itself."""
    found = {"": folder}
    for _ in range(depth):
        found = {f"{p}/{name}".lstrip("/"): f"{f}/{name}" for p, f in found.items()
                 for name, is_folder in _listed(spark, f) if is_folder and "=" in name}
    return found


def published(spark: SparkSession, root: str, depth: int) -> dict[str, str]:
    """Partition name -> folder of the last publish, as the folders tell."""
    held = _partition_folders(spark, root, depth) if depth else {}
    for folder, mark in _marks(spark, root):
        if mark is not None:
            held.update(_partition_folders(spark, folder, depth))
            held = {p: f for p, f in held.items() if p not in mark["emptied"]}
    return held


def remove_retired(spark: SparkSession, table: str, older_than: dt.timedelta) -> list[str]:
    """Delete the folders that the table has not pointed at for ``older_than``, and
    staged ones of that age that were never published; returns them.

    Its own step: run it with an age above that of the longest query.  A
    folder that the catalog still points at is never deleted.
    """
    root, depth = table_root(spark, table), len(partition_columns(spark, table))
    limit, gone = time.time() - older_than.total_seconds(), []
    owner = _partition_folders(spark, root, depth)
    if not depth and all(name.startswith("_") for name, _ in _listed(spark, root)):
        owner = {}                               # an unpartitioned table without rows of its own
    for folder, mark in _marks(spark, root):
        if mark is None:
            if int(folder.rsplit("/v", 1)[1].split("-")[0]) / 1000 < limit:
                gone.append(folder)
            continue
        new = _partition_folders(spark, folder, depth)
        for p in [*new, *mark["emptied"]]:
            old = owner.pop(p, None)
            if old is not None and mark["at"] < limit and not _points_at(spark, table, p, old):
                gone.append(old)
        owner.update(new)
    for folder in gone:
        if folder == root:                       # the first rows of an unpartitioned table
            for name, _ in _listed(spark, root):
                if not name.startswith("_"):
                    _delete(spark, f"{root}/{name}")
        else:
            _delete(spark, folder)
    return gone


def _points_at(spark: SparkSession, table: str, partition: str, folder: str) -> bool:
    try:
        place = _described(spark, table, f" {_spec(partition)}" if partition else "")["Location"]
    except AnalysisException:                    # no such partition
        return False
    path = _path(spark, folder)
    return _fs(spark, folder).makeQualified(path).toString() == _fs(spark, place).makeQualified(
        _path(spark, place)).toString()


def leftovers(spark: SparkSession, table: str) -> list[str]:
    """Staging tables of ``table`` that still stand, and its staged folders that were never published."""
    root = f"{table_root(spark, table)}/{VERSIONS}/"
    staging = [t.name for t in spark.catalog.listTables() if t.name.startswith("stage_")
               and layout(spark, t.name).root.startswith(root)]
    return sorted(staging) + [folder for folder, mark in _marks(spark, root.rsplit("/", 2)[0]) if mark is None]


def read_back(spark: SparkSession, table: str) -> DataFrame:
    """What the catalog holds of a table, as rows (kind, name, detail): its columns with
    their types, partition and bucket columns, partitions, and what staging left behind."""
    held = layout(spark, table)
    rows = [("column", c.name, c.dataType) for c in spark.catalog.listColumns(table)]
    rows += [("partitioned by", c, str(k)) for k, c in enumerate(held.partitions)]
    rows += [("bucketed by", c, str(held.buckets)) for c in held.bucket_by]
    rows += [("partition", p, "") for p in (partitions(spark, table) if held.partitions else ())]
    rows += [("left behind", name, "") for name in leftovers(spark, table)]
    return spark.createDataFrame(rows, "kind string, name string, detail string")


def replace_partition(spark: SparkSession, stage: str, table: str, partition: dict[str, object]) -> None:
    """Make ``partition`` of ``table`` the rows of the staged copy ``stage``;
    an empty copy empties it."""
    publish_stage(spark, stage, table, [partition_name(partition)])


def insert_overwrite_partition(spark: SparkSession, df: DataFrame, table: str,
                               partition: dict[str, object], aligned: bool = False) -> None:
    """Replace one partition by ``df`` (its columns without the partition's);
    ``df`` may read ``table`` itself, since it is staged first."""
    schema = spark.table(table).schema
    for k, v in partition.items():
        df = df.withColumn(k, F.lit(v if v is None else str(v)).cast(schema[k].dataType))
    with staged(spark, df, table, aligned) as name:
        replace_partition(spark, name, table, partition)


def insert_overwrite_dynamic(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Overwrite only the partitions present in ``df``."""
    with staged(spark, df, table) as name:
        publish_stage(spark, name, table)


def replace_table(spark: SparkSession, stage: str, table: str) -> None:
    """Make the whole of ``table`` the rows of the staged copy ``stage``."""
    publish_stage(spark, stage, table, partitions(spark, table) if partition_columns(spark, table) else ())


def insert_overwrite_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace the whole table's contents."""
    with staged(spark, df, table) as name:
        replace_table(spark, name, table)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _literal(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, dt.datetime):
        return f"TIMESTAMP_NTZ '{v.isoformat(sep=' ')}'"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, (bool, int, float)):
        return str(v)
    s = str(v)
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", s):
        return f"DATE '{s}'"
    return _quoted(s)


# ---------------------------------------------------------------------------
# OLAP cube table (A13 sink, A14 reads)
# ---------------------------------------------------------------------------

def write_cube(spark: SparkSession, cube: DataFrame, table: str) -> None:
    """Store an A13 cube partitioned by (ds, agg_level), replacing the
    partitions it covers.  The grand-total level '' is stored under
    ``TOTAL_LEVEL``."""
    from kestrel import schemas
    ensure_table(spark, table, schemas.OLAP_CUBE, ("ds", "agg_level"))
    lvl = F.when(F.col("agg_level") == "", F.lit(TOTAL_LEVEL)).otherwise(F.col("agg_level"))
    insert_overwrite_dynamic(spark, cube.withColumn("agg_level", lvl), table)


def read_level(spark: SparkSession, table: str, ds: str | dt.date, level: str) -> DataFrame:
    """One aggregation level of one day; both filters are on
    partition columns, so only that folder is listed and read."""
    stored = TOTAL_LEVEL if level == "" else level
    t = spark.table(table)
    out = t.filter((F.col("ds") == F.lit(str(ds)).cast("date")) & (F.col("agg_level") == stored))
    lvl = F.when(F.col("agg_level") == TOTAL_LEVEL, F.lit("")).otherwise(F.col("agg_level"))
    return out.select("host", "browser_type", "device_type", "os_type", "page_hits", "ds",
                      lvl.alias("agg_level"))
