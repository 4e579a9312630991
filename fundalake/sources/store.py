"""The table store: versions of Parquet folders, keyed upserts by folders, change sets, statistics and reads."""

from __future__ import annotations

import json
import time
import uuid
import zlib
from collections.abc import Callable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundalake.operators.windows import dedup_by
from fundalake.sources.schemas import KEYS, conform

#: Buckets of a table without a date in its key, and of one that is made company by company.
BUCKETS = 16
#: Versions whose change sets a table remembers.
REMEMBERED = 64
#: Seconds after which a version that another writer has claimed, and not completed, is given up.
PATIENCE = 600.0


def matching(keys: Sequence[str]) -> list[Column]:
    """Join conditions with a side whose columns are named _n_key; null keys are equal."""
    return [F.col(f"`{k}`").eqNullSafe(F.col(f"`_n_{k}`")) for k in keys]


def only(df: DataFrame, units: DataFrame) -> DataFrame:
    """The rows of ``df`` whose values in the columns of ``units`` are there."""
    keys = units.columns
    return df.join(units.withColumnsRenamed({k: f"_n_{k}" for k in keys}), matching(keys), "left_semi")


def without(df: DataFrame, units: DataFrame) -> DataFrame:
    """The other rows."""
    keys = units.columns
    return df.join(units.withColumnsRenamed({k: f"_n_{k}" for k in keys}), matching(keys), "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None = None) -> DataFrame:
    """``old`` without the rows whose key ``new`` has, and ``new``; null keys are equal.  With ``order_by`` one row per key of the new ones stays."""
    if order_by:
        new = dedup_by(new, list(keys), order_by)
    return without(old, new.select(*keys).distinct()).unionByName(new)


class Layout(NamedTuple):
    """How a table is dealt over folders: by the year of a date, or by ``n`` buckets of a column's hash."""

    kind: str
    column: str
    n: int = 0

    @classmethod
    def of(cls, schema: T.StructType, keys: Sequence[str]) -> Layout | None:
        """By the last date of the key; without one, by buckets of its first column."""
        for k in reversed(keys):
            if isinstance(schema[k].dataType, T.DateType):
                return cls("year", k)
        return cls("bucket", keys[0], BUCKETS) if keys else None

    @property
    def folder(self) -> str:
        return f"{self.kind}_of_{self.column}"

    def label(self) -> Column:
        """What the folder of a row is called."""
        c = F.col(f"`{self.column}`")
        if self.kind == "year":
            return F.coalesce(F.year(c).cast("string"), F.lit("none"))
        return F.when(c.isNull(), "none").otherwise(F.lpad(F.pmod(F.crc32(c.cast("string")), F.lit(self.n)).cast("string"), 4, "0"))

    def labels_of(self, values: Sequence[str]) -> set[str]:
        """The labels of some values of a bucketed column."""
        return {f"{zlib.crc32(v.encode()) % self.n:04d}" for v in values}


_WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"), ("float", "double"), ("tinyint", "double"), ("smallint", "double"), ("int", "double")}


def united(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, the old ones first, each with the wider of its types; types of which neither holds the other are refused."""
    have = {f.name: f for f in old}
    out = {f.name: f.dataType for f in old}
    for f in new:
        a, b = (have[f.name].dataType, f.dataType) if f.name in have else (f.dataType, f.dataType)
        x, y = a.simpleString(), b.simpleString()
        if x != y and (x, y) not in _WIDER and (y, x) not in _WIDER:
            raise ValueError(f"column {f.name}: {y} does not go with {x}")
        out[f.name] = b if (x, y) in _WIDER else a
    return T.StructType([T.StructField(n, t) for n, t in out.items()])


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; those it lacks are null."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def _difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of which one side has more than the other."""
    both = a.withColumn("_side", F.lit(1)).unionByName(b.withColumn("_side", F.lit(-1)))
    return both.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("_side").alias("_more")).filter("_more <> 0")


class Version(NamedTuple):
    """A manifest: schema, folders, layout, and for each earlier version, by number, the folder of the keys it changed (none: not known); what a derived table was made of."""

    number: int
    schema: T.StructType
    folders: list[str]
    layout: Layout | None
    changes: dict[int, str | None]
    sources: dict[str, int | str]


class Store:
    """Tables under a root folder.

    ``versions`` has a manifest for each version of a table.  A complete one is
    marked with _SUCCESS, so readers never see half a table.  A keyed
    table lies in a folder for each year of the (last) date of its key, or for
    each bucket of its first key; an upsert reads and writes only the folders
    that the new rows are in, and the next manifest names the others as they are.

    A version's number is claimed by creating a file that must not be there yet.
    Of two writers one claims it; the other waits for that version and merges its
    rows again, into it, so no rows are lost.

    Each upsert leaves the keys it has changed as a change set; a table derived
    from others records their versions, and asks for what has changed since.

    An upsert may bring columns that the table lacks, or wider types: old folders
    are read with nulls, and widened.  A type that does not hold the old one, or
    is not held by it, is refused.
    """

    def __init__(self, spark: SparkSession, root: str, patience: float = PATIENCE) -> None:
        self.spark, self.root, self.patience = spark, root.rstrip("/"), patience
        self._read: dict[tuple[str, str], Version] = {}  # manifests do not change

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _versions(self, table: str) -> list[str]:
        fs, p = self._fs(f"{self.root}/{table}/versions")
        if not fs.exists(p):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))

    def _manifest(self, table: str, version: str) -> Version:
        if (table, version) in self._read:
            return self._read[table, version]
        lines = [r.value for r in self.spark.read.text(f"{self.root}/{table}/versions/{version}").collect()]
        (schema,) = [x for x in lines if x.startswith("{")]
        (more,) = [json.loads(x[1:]) for x in lines if x.startswith("@")]
        layout = Layout(*more["layout"]) if more["layout"] else None
        folders = sorted(x for x in lines if x[0] not in "{@")
        self._read[table, version] = Version(int(version.split("-")[0]), T.StructType.fromJson(json.loads(schema)), folders, layout, {int(k): v for k, v in more["changes"].items()}, more["sources"])
        return self._read[table, version]

    def version(self, table: str, number: int | None = None) -> Version:
        """The current version of a table, or one by its number."""
        done = [v for v in self._versions(table) if number is None or int(v.split("-")[0]) == number]
        if not done:
            raise FileNotFoundError(table if number is None else f"{table}, version {number}")
        return self._manifest(table, done[-1])

    def exists(self, table: str) -> bool:
        return bool(self._versions(table))

    def folders(self, table: str) -> list[str]:
        """The data folders of the current version, below the table's own."""
        return self.version(table).folders

    def read(self, table: str, number: int | None = None) -> DataFrame:
        v = self.version(table, number)
        return self._scan(table, v.schema, v.folders)

    def holding(self, table: str, units: DataFrame, number: int | None = None) -> DataFrame:
        """The rows whose values in the columns of ``units`` are there; folders that cannot hold any are not read."""
        v = self.version(table, number)
        return only(self._scan(table, v.schema, self._near(v, units)), units)

    def select(self, table: str, date: str, tickers: Sequence[str] | None = None, start: str | None = None, end: str | None = None, country: str | None = None) -> DataFrame:
        """``filtered`` rows of a table; only the folders of the years, or of the tickers' buckets, are listed and read."""
        v = self.version(table)
        folders = v.folders
        label = lambda f: f.rsplit("=", 1)[-1]
        if v.layout and v.layout.kind == "year" and v.layout.column == date:
            low, high = (int(x[:4]) if x else None for x in (start, end))
            if start or end:
                folders = [f for f in folders if label(f) != "none" and (low is None or int(label(f)) >= low) and (high is None or int(label(f)) <= high)]
        elif v.layout and v.layout.kind == "bucket" and v.layout.column == "ticker" and tickers is not None:
            folders = [f for f in folders if label(f) in v.layout.labels_of(tickers)]
        return filtered(self._scan(table, v.schema, folders), date, tickers, start, end, country)

    def _scan(self, table: str, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{table}/{f}" for f in folders])

    def _near(self, v: Version, units: DataFrame, layout: Layout | None = None) -> list[str]:
        """The folders that may hold ``units``: those of their labels, and those that are not dealt by the layout."""
        layout = layout or v.layout
        if layout is None or layout != v.layout or layout.column not in units.columns:
            return v.folders
        labels = {r[0] for r in units.select(layout.label()).distinct().collect()}  # years, or buckets
        return [f for f in v.folders if f.rsplit("/", 1)[1].split("=")[0].rstrip("_") != layout.folder or f.rsplit("=", 1)[1] in labels]

    def _put(self, table: str, df: DataFrame, layout: Layout | None, sort: Sequence[str]) -> list[str]:
        """Data in a new folder, or a folder for each label of the layout; which ones."""
        name = f"data/{uuid.uuid4().hex}"
        if layout is None:
            (df.sortWithinPartitions(*sort) if sort else df).write.parquet(f"{self.root}/{table}/{name}")
            return [name]
        label = layout.folder
        while label in df.columns:
            label += "_"
        # AQE splits a folder that is large over several tasks
        df.withColumn(label, layout.label()).hint("rebalance", label).sortWithinPartitions(label, *sort).write.partitionBy(label).parquet(f"{self.root}/{table}/{name}")
        fs, p = self._fs(f"{self.root}/{table}/{name}")
        return [f"{name}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory()]

    def _drop(self, table: str, folders: Sequence[str]) -> None:
        for f in folders:
            fs, p = self._fs(f"{self.root}/{table}/{f}")
            fs.delete(p, True)

    def _claim(self, table: str, number: int) -> bool:
        """Whether this writer may make the version of that number."""
        fs, p = self._fs(f"{self.root}/{table}/claims/{number:010d}")
        fs.mkdirs(p.getParent())
        try:
            if fs.getUri().getScheme() == "file":  # Hadoop's local file system looks first and creates then
                file = self.spark._jvm.java.nio.file.Path.of(p.toUri().getPath(), self.spark._sc._gateway.new_array(self.spark._jvm.java.lang.String, 0))
                self.spark._jvm.java.nio.file.Files.createFile(file, self.spark._sc._gateway.new_array(self.spark._jvm.java.nio.file.attribute.FileAttribute, 0))
            else:
                fs.create(p, False).close()
        except Py4JJavaError as e:
            if "AlreadyExists" in str(e.java_exception):
                return False
            raise
        return True

    def _commit(self, table: str, base: int, schema: T.StructType, folders: Sequence[str], layout: Layout | None, changes: dict[int, str | None], changed: str | None, sources: dict[str, int | str], keep: int) -> bool:
        """The version after ``base``; False if another writer has made it.  Older ones but the last ``keep`` go, with the folders that no other names."""
        number = base + 1
        while not self._claim(table, number):
            until = time.monotonic() + self.patience
            while time.monotonic() < until:
                if any(int(v.split("-")[0]) >= number for v in self._versions(table)):
                    return False
                time.sleep(0.2)
            number += 1  # its writer is gone
        recent = dict(sorted({**changes, number: changed}.items())[-REMEMBERED:])
        more = "@" + json.dumps({"layout": layout, "changes": recent, "sources": sources})
        name = f"{number:010d}-{uuid.uuid4().hex[:8]}"
        for file, text in (("manifest", "\n".join((schema.json(), more, *folders))), ("_SUCCESS", "")):
            fs, p = self._fs(f"{self.root}/{table}/versions/{name}/{file}")
            out = fs.create(p, True)
            out.write(text.encode())
            out.close()
        self._read[table, name] = Version(number, schema, sorted(folders), layout, recent, sources)
        done = self._versions(table)
        named = lambda v: {*v.folders, *(c for c in v.changes.values() if c)}
        stay = {f for x in done[-keep:] for f in named(self._manifest(table, x))}
        for x in done[:-keep]:
            self._drop(table, [*(f for f in named(self._manifest(table, x)) if f not in stay), f"versions/{x}"])
        return True

    def write(self, table: str, df: DataFrame, sort: Sequence[str] = (), keep: int = 2, layout: Layout | None = None, sources: dict[str, int | str] | None = None) -> None:
        """Replace a table; what has changed is not known afterwards."""
        folders = self._put(table, df, layout, sort)
        while True:
            done = self._versions(table)
            v = self._manifest(table, done[-1]) if done else None
            if self._commit(table, v.number if v else -1, df.schema, folders, layout, v.changes if v else {}, None, sources or {}, keep):
                return

    def upsert(self, table: str, new: DataFrame, keys: Sequence[str] | None = None, order_by: Sequence[Column] | None = None, keep: int = 2) -> None:
        """The rows of ``new`` in place of those with their keys."""
        keys = list(keys or KEYS[table])
        new = conform(new, table, more=True) if table in KEYS else new
        if order_by:
            new = dedup_by(new, keys, order_by)
        self.patch(table, new, None, keys, keep=keep)

    def patch(self, table: str, new: DataFrame, gone: DataFrame | None, keys: Sequence[str], sort: Sequence[str] = (), layout: Layout | None = None, sources: dict[str, int | str] | None = None, keep: int = 2) -> None:
        """The rows of ``new`` in place of those of the units ``gone`` (columns that name them; none: the keys of ``new``).

        The new rows are written first, so that they are computed once and show
        which folders they touch.  The other folders are left alone.  The change
        set has the keys of the rows that are new, gone or not what they were.
        """
        layout, sort = layout or Layout.of(new.schema, keys), list(sort or keys)
        arrived = self._put(table, new, layout, sort)
        rows = self._scan(table, new.schema, arrived)
        gone = rows.select(*keys).distinct() if gone is None else gone
        while True:
            done = self._versions(table)
            if not done:
                if self._commit(table, -1, new.schema, arrived, layout, {}, None, sources or {}, keep):
                    return
                continue
            v = self._manifest(table, done[-1])
            schema = united(v.schema, new.schema)
            near = set(self._near(v, gone, layout)) | set(self._near(v, rows, layout))
            touched = [f for f in v.folders if f in near]
            old, ours = shaped(self._scan(table, schema, touched), schema), shaped(rows, schema)
            replaced = only(old, gone)
            changed = f"changes/{uuid.uuid4().hex}"
            _difference(replaced, ours).select(*keys).distinct().write.parquet(f"{self.root}/{table}/{changed}")
            written = self._put(table, without(old, gone).unionByName(ours), layout, sort)
            if self._commit(table, v.number, schema, [*[f for f in v.folders if f not in near], *written], layout, v.changes, changed, sources or v.sources, keep):
                break
            self._drop(table, [*written, changed])
        self._drop(table, arrived)

    def changes(self, table: str, since: int) -> DataFrame | None:
        """The keys that the versions after number ``since`` have changed; None if that is not known."""
        v = self.version(table)
        parts = [p for number, p in v.changes.items() if number > since]
        if since < min(v.changes) - 1 or None in parts:
            return None
        if not parts:
            return self.read(table).limit(0)
        return self.spark.read.parquet(*[f"{self.root}/{table}/{p}" for p in parts]).distinct()

    def refresh(self, source: str, target: str, change: Callable[[DataFrame], DataFrame] = lambda d: d, sort: Sequence[str] = ()) -> None:
        """Replace a table by another one, changed; see plans.refresh for one that follows only what has changed."""
        self.write(target, change(self.read(source)), sort)

    def tables(self) -> list[str]:
        fs, p = self._fs(self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory() and self.exists(s.getPath().getName())) if fs.exists(p) else []

    def catalog(self) -> DataFrame:
        """(table_name, n_rows)."""
        parts = [self.read(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("n_rows")) for t in self.tables()]
        out = self.spark.createDataFrame([], "table_name string, n_rows long")
        for part in parts:
            out = out.unionByName(part)
        return out

    def size(self) -> DataFrame:
        """(table_name, n_bytes) of the current versions."""
        rows = []
        for t in self.tables():
            fs, _ = self._fs(self.root)
            rows.append((t, sum(fs.getContentSummary(self._fs(f"{self.root}/{t}/{f}")[1]).getLength() for f in self.folders(t))))
        return self.spark.createDataFrame(rows, "table_name string, n_bytes long")

    def canned(self, name: str) -> DataFrame:
        """One of the fixed catalog queries: tables, row_counts (largest first), schemas (columns and types), size."""
        if name == "tables":
            return self.spark.createDataFrame([(t,) for t in self.tables()], "table_name string")
        if name == "row_counts":
            return self.catalog().orderBy(F.col("n_rows").desc(), "table_name")
        if name == "schemas":
            return self.spark.createDataFrame([(t, f.name, f.dataType.simpleString()) for t in self.tables() for f in self.read(t).schema], "table_name string, column_name string, type string")
        if name == "size":
            return self.size().agg(F.sum("n_bytes").alias("n_bytes"))
        raise ValueError(name)

    def sql(self, query: str, args=None) -> DataFrame:
        """Ad-hoc SQL over the tables as views, with parameters; the views are those of a session of their own."""
        own = self.spark.newSession()
        for t in self.tables():
            Store(own, self.root).read(t).createOrReplaceTempView(t)
        return own.sql(query, args=args)



def table_range(df: DataFrame, date: str, country: str | None = None) -> DataFrame:
    rows = df.filter(F.col("country") == country) if country else df
    return rows.agg(F.count("*").alias("n_rows"), F.min(date).alias("min_date"), F.max(date).alias("max_date"))


def table_stats(tables: dict[str, tuple[DataFrame, str | None, str]]) -> DataFrame:
    """A row per table (frame, date column, entity column): rows, entities, first and last date."""
    out = None
    for name, (df, date, entity) in tables.items():
        dates = [F.min(date).alias("min_date"), F.max(date).alias("max_date")] if date else [F.lit(None).cast("date").alias("min_date"), F.lit(None).cast("date").alias("max_date")]
        part = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"), F.countDistinct(entity).alias("n_entities"), *dates)
        out = part if out is None else out.unionByName(part)
    return out


def filtered(df: DataFrame, date: str, tickers: Sequence[str] | None = None, start: str | None = None, end: str | None = None, country: str | None = None) -> DataFrame:
    """Rows by ticker, date range and country, ordered."""
    if tickers is not None:
        df = df.filter(F.col("ticker").isin(*tickers))
    if start is not None:
        df = df.filter(F.col(date) >= F.to_date(F.lit(start)))
    if end is not None:
        df = df.filter(F.col(date) <= F.to_date(F.lit(end)))
    if country is not None:
        df = df.filter(F.col("country") == country)
    return df.orderBy(*[c for c in ("ticker", date) if c in df.columns])


def load(df: DataFrame, columns: Sequence[str] | None = None, where: str | None = None, limit: int | None = None) -> DataFrame:
    if where:
        df = df.filter(F.expr(where))
    if columns:
        df = df.select(*columns)
    return df.limit(limit) if limit is not None else df


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
