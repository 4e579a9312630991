"""Boosted trees of second order on binned features.

Features become bin numbers at exact quantiles; a bin takes a byte.  For each
level of a tree every task adds up the gradients and hessians of its rows by
(node, feature, bin) in one array; the arrays are folded in tasks until few are
left, and the driver sums these and splits the nodes: what it holds depends on
nodes, features and bins, not on rows.  A split needs a positive gain with the L2
term and enough hessian on both sides.

Rows are sampled for each tree by a hash of their key, columns by a hash of their
place, so reruns and other partitionings grow the same trees up to rounding.

Each row's margin is written again every ``REWRITTEN`` rounds; in between it is
that margin plus the few trees since, so a lost executor repeats at most those.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from fundalake.operators.ranks import long, quantiles
from fundalake.sources.staging import shared_dir

FAN = 16
REWRITTEN = 10
_ROWS = "y double, w double, h long, bins binary, margin double"


class Settings(NamedTuple):
    """``child``: least hessian of a child; ``l2`` on leaf values; ``least``: least gain; shares of rows and columns for each tree."""

    rounds: int = 300
    depth: int = 6
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    l2: float = 1.0
    child: float = 5.0
    least: float = 0.0
    positive: float = 1.0
    bins: int = 64
    seed: int = 42


class Tree(NamedTuple):
    """A full tree in heap order: node i has children 2 i + 1 (bins up to ``upto``) and 2 i + 2; feature -1: a leaf."""

    feature: np.ndarray
    upto: np.ndarray
    value: np.ndarray

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Where each row is after ``depth`` levels."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            f = self.feature[at]
            inner = f >= 0
            right = bins[np.arange(len(bins)), np.maximum(f, 0)] > self.upto[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """Hashes in [0, 1)."""
    x = h.view(np.uint64) ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))
    for k, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(k))) * np.uint64(m)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


def taken_rows(h: np.ndarray, s: Settings, tree: int) -> np.ndarray:
    return _mixed(h, 2 * (s.seed + tree) + 1) < s.rows


def taken_columns(k: int, s: Settings, tree: int) -> np.ndarray:
    """The numbers of the columns that a tree may use."""
    order = np.argsort(_mixed(np.arange(k, dtype=np.int64), 2 * (s.seed + tree)), kind="stable")
    return np.sort(order[: max(1, round(k * s.columns))])


def gradients(y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def splits(g: np.ndarray, h: np.ndarray, columns: np.ndarray, s: Settings) -> list[tuple[int, int] | None]:
    """For each node the best (feature, last bin on the left) by its sums (node, feature, bin); the first of equals."""
    left_g, left_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
    all_g, all_h = g[:, :1].sum(axis=2, keepdims=True), h[:, :1].sum(axis=2, keepdims=True)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = (left_g**2 / (left_h + s.l2) + right_g**2 / (right_h + s.l2) - all_g**2 / (all_h + s.l2)) / 2
    gain = np.where((left_h >= s.child) & (right_h >= s.child), gain, -np.inf).reshape(len(g), -1)
    best = gain.argmax(axis=1)
    bins = left_g.shape[2]
    return [(int(columns[b // bins]), int(b % bins)) if gain[i, b] > max(s.least, 1e-12) else None for i, b in enumerate(best)]


class Boosted:
    """Trees over binned columns; ``cuts``: each column's bounds, a value is in bin i if i of them are less."""

    def __init__(self, columns: list[str], cuts: list[np.ndarray], depth: int) -> None:
        self.columns, self.cuts, self.depth = columns, cuts, depth
        self.trees: list[Tree] = []

    def binned(self, values: Sequence[pa.Array]) -> np.ndarray:
        """Bin numbers; null and NaN count as the least value."""
        out = np.zeros((len(values[0]), len(values)), np.uint8)
        for i, (v, cut) in enumerate(zip(values, self.cuts)):
            x = v.fill_null(-np.inf).to_numpy(zero_copy_only=False)
            out[:, i] = np.searchsorted(cut, np.where(np.isnan(x), -np.inf, x))
        return out

    def margin(self, bins: np.ndarray, since: int = 0) -> np.ndarray:
        out = np.zeros(len(bins))
        for tree in self.trees[since:]:
            out += tree.value[tree.nodes(bins, self.depth)]
        return out

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with score, the probability of the positive class."""
        names = [f"_x{i}" for i in range(len(self.columns))]
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(self.columns, names)])

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p = 1 / (1 + np.exp(-self.margin(self.binned(batch.columns[1:]))))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p)], names=["row", "score"])

        out = rows.mapInArrow(scored, StructType([rows.schema["row"], StructField("score", DoubleType())]))
        return out.select("row.*", "score")

    def importance(self) -> list[int]:
        """How many splits use each column."""
        used = np.concatenate([t.feature for t in self.trees]) if self.trees else np.zeros(0, np.int64)
        return np.bincount(used[used >= 0], minlength=len(self.columns)).tolist()


def _summed(parts: DataFrame, tasks: int, shape: tuple[int, ...]) -> np.ndarray:
    """The sum of the arrays of all tasks (slot, data): by FAN in a task until at most FAN are left, whatever the number of tasks."""

    def level(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(d) for d in table.sort_by("slot")["data"].to_pylist()], axis=0)
        return pa.table({"slot": [table["slot"][0].as_py() // FAN], "data": [total.tobytes()]})

    while tasks > FAN:
        parts = parts.groupBy(F.floor(F.col("slot") / FAN).alias("group")).applyInArrow(level, "slot long, data binary")
        tasks = -(-tasks // FAN)
    rows = sorted(parts.collect(), key=lambda r: r.slot)
    return np.sum([np.frombuffer(r.data) for r in rows], axis=0).reshape(shape) if rows else np.zeros(shape)


def fit(df: DataFrame, columns: list[str], label: str, keys: Sequence[str] = ("ticker", "date"), s: Settings = Settings()) -> Boosted:
    """Trees for a label of 0 and 1; rows with a null label are left out."""
    rows = df.filter(F.col(label).isNotNull())
    ps = [i / s.bins for i in range(1, s.bins)]
    found = {r.column: r._p for r in quantiles(long(rows, columns).filter(~F.isnan("value")), ["column"], "value", ps).collect()}  # a row per column
    model = Boosted(columns, [np.unique(found.get(c, [])) for c in columns], s.depth)
    k = len(columns)
    weight = F.when(F.col(label) == 1, F.lit(float(s.positive))).otherwise(1.0)
    start = rows.select(F.col(label).cast("double").alias("y"), weight.alias("w"), F.xxhash64(*keys).alias("h"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(columns)])

    def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = model.binned(b.columns[3:])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([x.tobytes() for x in bins], pa.binary()), pa.array(np.zeros(len(bins)))], names=["y", "w", "h", "bins", "margin"])

    def read(batches: Iterator[pa.RecordBatch], since: int) -> Iterator[tuple]:
        for b in batches:
            if b.num_rows:
                y, w, h = (c.to_numpy() for c in b.columns[:3])
                bins = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, k)
                yield b, y, w, h, bins, b.column(4).to_numpy() + model.margin(bins, since)

    def moved(batches: Iterator[pa.RecordBatch], since: int) -> Iterator[pa.RecordBatch]:
        for b, *_, margin in read(batches, since):
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(margin)], names=["y", "w", "h", "bins", "margin"])

    def sums(batches: Iterator[pa.RecordBatch], tree: Tree, number: int, level: int, use: np.ndarray, since: int) -> Iterator[pa.RecordBatch]:
        n, first = 1 << level, (1 << level) - 1
        out = np.zeros((2, n * len(use) * s.bins))
        for _, y, w, h, bins, margin in read(batches, since):
            at = tree.nodes(bins, level) - first
            pick = taken_rows(h, s, number) & (at >= 0)
            g, hs = gradients(y[pick], w[pick], margin[pick])
            for i, f in enumerate(use):
                place = (at[pick] * len(use) + i) * s.bins + bins[pick, f]
                out[0] += np.bincount(place, g, out.shape[1])
                out[1] += np.bincount(place, hs, out.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.tobytes()], pa.binary())], names=["slot", "data"])

    def written(data: DataFrame) -> DataFrame:
        path = f"{shared_dir(df.sparkSession)}/boosting-{uuid.uuid4().hex}"
        data.write.parquet(path)
        return df.sparkSession.read.schema(_ROWS).parquet(path).persist()

    data, since = written(start.mapInArrow(bin_rows, _ROWS)), 0
    tasks = data.rdd.getNumPartitions()
    for number in range(s.rounds):
        size = (2 << s.depth) - 1
        tree, use = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)), taken_columns(k, s, number)
        for level in range(s.depth + 1):
            n, first = 1 << level, (1 << level) - 1
            g, h = _summed(data.mapInArrow(lambda it, t=tree, r=number, lv=level, u=use, a=since: sums(it, t, r, lv, u, a), "slot long, data binary"), tasks, (2, n, len(use), s.bins))
            tree.value[first : first + n] = -s.rate * g[:, 0].sum(axis=1) / (h[:, 0].sum(axis=1) + s.l2)
            if level < s.depth:
                for i, best in enumerate(splits(g, h, use, s)):
                    if best:
                        tree.feature[first + i], tree.upto[first + i] = best
                if (tree.feature[first : first + n] < 0).all():
                    break
        model.trees.append(tree)
        if len(model.trees) - since >= REWRITTEN and number < s.rounds - 1:
            old, data = data, written(data.mapInArrow(lambda it, a=since: moved(it, a), _ROWS))
            old.unpersist()
            since, tasks = len(model.trees), data.rdd.getNumPartitions()
    data.unpersist()
    return model
