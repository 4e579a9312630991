"""Helpers shared by the training-data operators.

Texts reach Python as Arrow batches.  ``Words`` turns a batch into arrays: one
64-bit hash per word, and the word range of each document, so that everything
after it works on whole arrays and not on single words.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space and \t \n \v \f \r: what separates words in every contract here.
SPACES = b" \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"
#: Bytes of text that are turned into arrays at a time.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_ROLL = 0xD6E8FEB86659FD93
_MASK = (1 << 64) - 1
_is_space = np.zeros(256, bool)
_is_space[list(SPACES)] = True


def words_column(text) -> F.Column:
    """The non-empty words of a text; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPLIT), lambda w: w != "")


def count_words(text) -> F.Column:
    """Number of words, without keeping them: the text is replaced by one space for each run of other characters, and measured."""
    parts = F.size(F.split(F.coalesce(text, F.lit("")), SPLIT)).cast("long")
    t = F.coalesce(text, F.lit(""))
    lead = F.when(F.substring(t, 1, 1).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    tail = F.when(F.substring(t, -1, 1).rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    n = parts - lead - tail
    return F.when((F.length(t) == 0) | (n < 0), F.lit(0).cast("long")).otherwise(n)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only where none is set and the master is local (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if at is None:
        jdir = sc._jsc.sc().getCheckpointDir()
        if jdir.isDefined():
            at = jdir.get()
        elif sc.master.startswith("local"):
            at = "file://" + tempfile.mkdtemp(prefix="fundalake-ckpt-")
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(at)
    return at


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


#: Most rows of a side of a join that are sent to all executors, if the side is small in bytes as well.
SMALL_ROWS = 1 << 18
SMALL_BYTES = 32 << 20


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df``, which is read from a written table, marked for broadcast if its rows and their bytes are counted and few; otherwise as it is, for a shuffled join."""
    rows = SMALL_ROWS if rows is None else rows
    sizes = [F.sum(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`"))))) if f.dataType.typeName() in ("array", "struct", "map") else F.sum(F.octet_length(F.col(f"`{f.name}`"))) if f.dataType.typeName() in ("string", "binary") else F.count("*") * 8 for f in df.schema.fields]
    n, *found = df.agg(F.count("*"), *sizes).first()
    return F.broadcast(df) if n <= rows and sum(x or 0 for x in found) <= SMALL_BYTES else df


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def row_key(df: DataFrame, columns: list[str] | None = None) -> F.Column:
    """128 bits of hash over the columns of a row, as a string; rows with one key are equal in them."""
    names = df.columns if columns is None else columns
    values = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in df.schema[c].dataType.simpleString() else F.col(f"`{c}`") for c in names]
    parts = [x for v in values for x in (v.isNull(), v)]
    return F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), *parts)), 16, "0") for i in (1, 2)])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's bounds in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


class Words:
    """Hashes of the words of some texts.

    hashes[i] is word i's; the words of text d are first[d]:first[d + 1];
    start and end are each word's bounds in ``raw``.
    """

    def __init__(self, raw: np.ndarray, at: np.ndarray, space: np.ndarray = _is_space) -> None:
        self.raw, self.at = raw, at
        n = len(raw)
        gap = space[raw]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        after_gap = np.ones(n, bool)
        before_gap = np.ones(n, bool)
        if n:
            after_gap[1:] = gap[:-1]
            before_gap[:-1] = gap[1:]
        word = ~gap
        self.start = np.flatnonzero(word & (after_gap | edge[:-1]))
        self.end = np.flatnonzero(word & (before_gap | edge[1:])) + 1
        self.first = np.searchsorted(self.start, at)
        if len(self.start):
            length = self.end - self.start
            head = self.start[0]
            inside = np.arange(head, n) - np.repeat(self.start, np.diff(np.append(self.start, n)))
            part = (raw[head:].astype(np.uint64) + np.uint64(1)) * powers(_BASE, int(inside.max()) + 1)[inside]
            part[gap[head:]] = 0
            self.hashes = mix(np.add.reduceat(part, self.start - head) + length.astype(np.uint64))
        else:
            self.hashes = np.zeros(0, np.uint64)

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def starts(self, k: int) -> np.ndarray:
        """Positions at which k words of one text begin."""
        n = len(self) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        d = self.doc()
        return np.flatnonzero(d[:n] == d[k - 1 :])


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of h[i : i + k] for each i, made by doubling."""
    done, out, block, size = 0, None, h, 1
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    while True:
        if k & size:
            piece = block[done : done + n]
            out = piece if out is None else out * np.uint64(pow(_ROLL, size, 1 << 64)) + piece
            done += size
        if size * 2 > k:
            return mix(out)
        block = block[:-size] * np.uint64(pow(_ROLL, size, 1 << 64)) + block[size:]
        size *= 2


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about ``most`` bytes of text (one long text stays whole), with that text's buffers."""
    for batch in batches:
        raw, at = text_buffers(batch.column(batch.schema.get_field_index(column)))
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
            yield batch.slice(i, j - i), raw[at[i] : at[j]], at[i : j + 1] - at[i]
            i = j


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable from each node of ``edges``.

    Alternating large and small stars.  Each round is two aggregations with
    partial sums and two joins that AQE may split, written to the checkpoint
    folder; the number of rounds grows with the logarithm of the diameter.
    """
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both.u == least.w).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(down, large.u == down.w).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        e = cut(small)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        seen = now
