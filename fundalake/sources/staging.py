"""Intermediate tables that several queries begin with: written once, then scanned with pruning and pushdown."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

_staged: dict[tuple[str, str, str, tuple], str] = {}
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints; a temporary one only where none is set and the master is local."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if at is None and not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster") and at is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    if at is None and app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="fundalake-")
    at = at or _own[app]
    return at.rstrip("/")


def _state(spark: SparkSession, source: str) -> tuple:
    """Names, sizes and times of what lies in the folder ``source`` (of a table in a folder, its files'); other data gives another state."""
    p = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(p):
        files = fs.listStatus(s.getPath()) if s.isDirectory() else [s]
        found.append((s.getPath().getName(), len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)))
    return tuple(sorted(found))


def staged(spark: SparkSession, source: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The table ``name`` made from the data in the folder ``source``; made at first use in an application, and again when those data change."""
    key = (spark.sparkContext.applicationId, source, name, _state(spark, source))
    if key not in _staged:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        make().write.parquet(path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])


def folder(spark: SparkSession, source: str, table: str, name: str, make: Callable[[], DataFrame]) -> str:
    """A folder in which the base table ``table`` is what ``make`` gives, a part of that in the folder ``source``; made as ``staged`` is."""
    key = (spark.sparkContext.applicationId, source, f"folder/{name}", _state(spark, source))
    if key not in _staged:
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        make().write.parquet(f"{path}/{table}.parquet")
        _staged[key] = path
    return _staged[key]


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read from there: what follows plans, and after a lost executor recomputes, from that table."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def landed(spark: SparkSession, source: str, name: str, rows: DataFrame, file: Column, form: str) -> str:
    """A folder with one CSV or JSON file of ``rows`` for each value of ``file``, its name; landed at first use in an application, and again when the data in the folder ``source`` change."""
    key = (spark.sparkContext.applicationId, source, f"landed/{name}", _state(spark, source))
    if key not in _staged:
        path = f"{shared_dir(spark)}/landed-{name}-{uuid.uuid4().hex}"
        named = rows.withColumn("_file", file).repartition("_file")
        getattr(named.write.partitionBy("_file").option("header", True), form)(f"{path}-parts")
        jvm = spark._jvm
        at, to = jvm.org.apache.hadoop.fs.Path(f"{path}-parts"), jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(to)
        for folder in fs.globStatus(jvm.org.apache.hadoop.fs.Path(at, "_file=*")):
            (part,) = [f for f in fs.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            fs.rename(part.getPath(), jvm.org.apache.hadoop.fs.Path(to, folder.getPath().getName()[len("_file=") :]))
        fs.delete(at, True)
        _staged[key] = path
    return _staged[key]
