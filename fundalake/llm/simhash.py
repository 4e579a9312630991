"""SimHash near-duplicates, linked through vantage-point trees.

A text's fingerprint is the bitwise majority of the XXH64 hashes of its word
shingles.  Fingerprints within ``radius`` bits are linked and the connected
groups are named by their least doc_id.

Trees.  The 64 bits are four parts of 16, and each part has a vantage-point
tree over the Hamming distance in that part.  A node splits its points at a
distance mu from a vantage point; by the triangle bound, a partner within r of
a point at distance d lies between d - r and d + r, so a point goes to the far
side of mu only, unless it is in the boundary strip mu < d <= mu + r: then it
goes to both sides, and the pair meets on the near one.  Leaves are the shards;
in a leaf, pairs are compared in the full distance, shell by shell from a
vantage point, and a shell only with those that its ball overlaps.

Why parts.  Fingerprints of unrelated texts lie at 32 +- 4 bits from any
vantage point, so in a tree over all 64 bits a strip of 4 holds over a third of
the points at every split; the README has measured sizes of such trees.  Two
fingerprints within 4 bits differ in at most 1 bit in one part at least, and a
strip of 1 in 16 bits holds less than a fifth.  Beyond ``WIDE`` points a shard
is a pair of leaves of two parts: at least two parts differ in at most 1 bit.
All cases are exact.

A tree is made from the counts of the 65,536 values of its part over all
points; it is a list of leaves for each value, which is sent to the tasks.

Size.  Equal fingerprints are one point.  A leaf that stays large holds near
copies or the values of a single part, and gives a spanning forest, never its
pairs.

Signatures.  One fingerprint at 4 bits finds few of the texts that share four
fifths of their shingles, so ``deduplicated`` makes a signature of several, each
from a remix of the hashes of the five-word shingles.  Two texts are linked if
one of the first ``SEARCHED`` fingerprints of each differ in at most ``radius``
bits, and all ``CHECKED`` together in at most ``bits``: the share of bits that
differ is the angle between the shingle sets over pi, 0.15 at a likeness of
0.8.  The trees first search the fingerprints alone, which are short; only
signatures with a partner there go through trees again, whole, and are linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import Words, chunks, components, cut, mix, partitions, row_key, windows

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Bits of a part; the points that a leaf should hold; beyond WIDE points, shards are pairs of leaves.
PART_BITS = 16
LEAF_ROWS = 8192
WIDE = 1 << 27
#: Vantage points that are tried at a node.
TRIES = 6
_PAIRS_AT_ONCE = 1 << 22
#: Signatures: words of a shingle, fingerprints that are searched and in all, bits that may differ in one that is searched and in all together.
NEAR_SHINGLE = 5
SEARCHED = 6
CHECKED = 8
NEAR_RADIUS = 7
NEAR_BITS = 80


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number; 0 if it has no word."""
    words = text.lower().split()
    if not words:
        return 0
    norm = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(norm, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(norm[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())], np.uint64)
    octets = h.view(np.uint8).reshape(-1, 8)
    if len(h) < 256:
        ones = np.unpackbits(octets, axis=1, bitorder="little").sum(0)
    else:
        ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > len(h)))


_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for part, raw, at in chunks(batches, "text"):
        data, cuts = raw.tobytes(), at.tolist()
        fps = np.array([fingerprint(data[a:b], shingle) for a, b in zip(cuts, cuts[1:])], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps), *part.columns[2:]], names=["doc_id", "fp", *part.schema.names[2:]])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp), a row per row of ``docs``."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id long, fp long")


class Tree:
    """A vantage-point tree over the Hamming distance of numbers of PART_BITS bits.

    leaves[first[v]:first[v + 1]] are the leaves that hold the value v.  Values
    within ``radius`` of each other have a leaf in common.
    """

    def __init__(self, weights: np.ndarray, radius: int, leaf_rows: float) -> None:
        self.radius, self.weights = radius, weights
        rng = np.random.default_rng(SEED)
        found, stack = [], [np.flatnonzero(weights)]
        while stack:
            cells = stack.pop()
            halves = self._split(cells, rng) if weights[cells].sum() > leaf_rows else None
            if halves is None:
                found.append(cells)
            else:
                stack += halves
        cell = np.concatenate(found) if found else np.zeros(0, np.int64)
        leaf = np.repeat(np.arange(len(found)), [len(c) for c in found])
        self.first = np.searchsorted(np.sort(cell), np.arange(len(weights) + 1)).astype(np.int32)
        self.leaves = leaf[np.argsort(cell, kind="stable")].astype(np.int32)

    def _split(self, cells: np.ndarray, rng: np.random.Generator) -> list[np.ndarray] | None:
        """The near and the far side of the best of some vantage points; None if no split makes the larger side smaller by a 20th."""
        w = self.weights[cells]
        best, most = None, 0.95 * w.sum()
        for v in cells[rng.integers(0, len(cells), TRIES)]:
            d = np.bitwise_count(cells ^ v).astype(np.int64)
            run = np.cumsum(np.bincount(d, w, PART_BITS + self.radius + 1))
            larger = np.maximum(run[self.radius : PART_BITS + self.radius], run[-1] - run[:PART_BITS])  # near with its strip, far; by mu
            mu = int(np.argmin(larger))
            if larger[mu] < most:
                best, most = (d, mu), larger[mu]
        if best is None:
            return None
        d, mu = best
        return [cells[d <= mu + self.radius], cells[d > mu]]


def _part(x, i: int):
    return (x >> (PART_BITS * i)) & ((1 << PART_BITS) - 1)


def trees(points: DataFrame, radius: int, n_points: int, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> tuple[list[Tree], int]:
    """A tree for each part, and how many parts a shard combines.

    The counts that come to the driver are at most 65,536 for each of the four parts.
    """
    n = 64 // PART_BITS
    combined = 1 if n_points <= wide else 2
    values = F.array(*[F.shiftrightunsigned("fp", PART_BITS * i).bitwiseAND((1 << PART_BITS) - 1) for i in range(n)])
    counts = points.select(F.posexplode(values).alias("part", "value")).groupBy("part", "value").agg(F.count("*").alias("n")).toArrow()
    part, value, count = (counts[c].to_numpy() for c in ("part", "value", "n"))
    # of the parts' differences at most ``radius`` in all, the ``combined`` least are no more than this
    each = radius // (n - combined + 1)
    rows = leaf_rows if combined == 1 else (leaf_rows * n_points) ** 0.5
    out = []
    for i in range(n):
        weights = np.zeros(1 << PART_BITS)
        weights[value[part == i]] = count[part == i]
        out.append(Tree(weights, each, rows))
    return out, combined


def route(fps: np.ndarray, forest_: list[Tree], combined: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, which): each point, by its index, once for each shard that it is in."""
    shards, rows = [], []
    for k, chosen in enumerate(combinations(range(len(forest_)), combined)):
        shard, row = np.full(len(fps), k, np.int64), np.arange(len(fps))
        for i in chosen:
            t, v = forest_[i], _part(fps[row], i).astype(np.int64)
            n = t.first[v + 1] - t.first[v]
            at = np.repeat(t.first[v] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            shard, row = (np.repeat(shard, n) << 26) | t.leaves[at], np.repeat(row, n)
        shards.append(shard)
        rows.append(row)
    return np.concatenate(shards), np.concatenate(rows)


def _route(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    forest_, combined = shared.value
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        shard, row = route(fps, forest_, combined)
        for i in range(0, len(row), 1 << 17):
            yield pa.RecordBatch.from_arrays([pa.array(shard[i : i + (1 << 17)]), pa.array(fps[row[i : i + (1 << 17)]].view(np.int64))], names=["shard", "fp"])


def shards(points: DataFrame, radius: int, n_points: int, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> DataFrame:
    """(shard, fp): each point once for each leaf that it is in."""
    shared = points.sparkSession.sparkContext.broadcast(trees(points, radius, n_points, leaf_rows, wide))
    return points.select("fp").mapInArrow(lambda it: _route(it, shared), "shard long, fp long")


def forest(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is connected among ``points`` by distances up to ``radius``."""
    n = len(points)
    shell = np.bitwise_count(points ^ points[0])
    order = np.argsort(shell, kind="stable")
    p, shell = points[order], shell[order].astype(np.int64)
    last = np.searchsorted(shell, shell + radius, "right")
    label, i = np.arange(n), 0
    while i < n:
        j = min(n, i + max(1, _PAIRS_AT_ONCE // (n - i)))
        width = int(last[j - 1])
        a, b = np.nonzero(np.bitwise_count(p[i:j, None] ^ p[None, i:width]) <= radius)
        a, b = a[a < b] + i, b[a < b] + i
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            open_ = label[a] != label[b]
            a, b = a[open_], b[open_]
        i = j
    while (label[label] != label).any():
        label = label[label]
    moved = np.flatnonzero(label != np.arange(n))
    return p[moved], p[label[moved]]


def sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``; a group is never cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        if held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        cut_at = int(np.searchsorted(keys, keys[-1]))
        if cut_at:
            yield pa.Table.from_batches([*held, batch.slice(0, cut_at)])
            held = []
        held.append(batch.slice(cut_at))
    if held:
        yield pa.Table.from_batches(held)


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, "shard"):
        fps = table["fp"].to_numpy().view(np.uint64)
        keys = table["shard"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        out = [forest(fps[a:b], radius) for a, b in zip(bounds[:-1], bounds[1:]) if b - a > 1]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[k] for x in out]).view(np.int64)) for k in (0, 1)], names=["a", "b"])


def links(points: DataFrame, radius: int = RADIUS, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> DataFrame:
    """(a, b): a spanning set of the links between different fingerprints."""
    dealt = shards(points, radius, points.count(), leaf_rows, wide).repartition(partitions(points.sparkSession), "shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(lambda it: _links(it, radius), "a long, b long")


def _components(points: DataFrame, radius: int) -> DataFrame:
    """``points`` with the fingerprint that names each one's component."""
    groups = components(links(points.select("fp"), radius)).withColumnRenamed("node", "fp")
    return points.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id), a row per row of ``docs``.

    Null and empty texts have fingerprint 0 and are linked like any other; a
    very long text is read whole; repeated rows are kept; a null doc_id gets the component of its text and
    names none (its component is null if it has only such rows).  Other
    columns are ignored; an empty table gives an empty result.
    """
    fps = cut(fingerprints(docs, shingle))
    rooted = _components(cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least"))), radius)
    named = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    return fps.join(rooted.select("fp", "component").join(named, "component").select("fp", "component_id"), "fp")


_REMIX = mix(np.arange(1, CHECKED + 1, dtype=np.uint64))


def signature(h: np.ndarray) -> np.ndarray:
    """CHECKED fingerprints of a text from the hashes of its shingles; zeros if it has none."""
    if len(h) < 256:
        ones = np.unpackbits(mix(h ^ _REMIX[:, None]).view(np.uint8).reshape(CHECKED, len(h), 8), axis=2, bitorder="little").sum(1)
    else:
        ones = np.zeros((CHECKED, 64), np.int64)
        for k in range(CHECKED):
            octets = mix(h ^ _REMIX[k]).view(np.uint8).reshape(-1, 8)
            ones[k] = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return np.packbits(2 * ones > len(h), axis=1, bitorder="little").view(np.uint64)[:, 0]


def text_signatures(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of CHECKED fingerprints for each text; A-Z count as a-z, and a text of fewer words than a shingle is one shingle."""
    words = Words(np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw), at)
    out = np.zeros((len(at) - 1, CHECKED), np.uint64)
    for d, (a, b) in enumerate(zip(words.first.tolist(), words.first[1:].tolist())):
        if b > a:
            out[d] = signature(windows(words.hashes[a:b], min(NEAR_SHINGLE, b - a)))
    return out


def _as_lists(s: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(s) + 1, dtype=np.int32) * CHECKED), pa.array(s.view(np.int64).ravel()))


def _from_lists(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, CHECKED).view(np.uint64) if isinstance(column, pa.Array) else _from_lists(column.combine_chunks())


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw, at in chunks(batches, "text"):
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), _as_lists(text_signatures(raw, at))], names=["doc_id", "key", "sig"])


def with_partners(points: DataFrame, radius: int, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> DataFrame:
    """Those of the different signatures (sig) of ``points`` that have another one within ``radius`` in a searched fingerprint."""
    found = None
    for k in range(SEARCHED):
        fps = cut(points.groupBy(F.col("sig")[k].alias("fp")).agg(F.count("*").alias("n")))
        ends = links(fps.select("fp"), radius, leaf_rows, wide).select(F.explode(F.array("a", "b")).alias("fp"))
        each = ends.union(fps.filter("n > 1").select("fp")).distinct().select(F.lit(k).alias("k"), "fp")
        found = each if found is None else found.union(each)
    each = points.select("sig", F.posexplode(F.slice("sig", 1, SEARCHED)).alias("k", "fp"))
    return cut(each.join(cut(found), ["k", "fp"], "left_semi").select("sig").distinct())


def _route_signatures(batches: Iterator[pa.RecordBatch], shared, k: int) -> Iterator[pa.RecordBatch]:
    forest_, combined = shared.value
    for batch in batches:
        s = _from_lists(batch.column(0))
        shard, row = route(s[:, k], forest_, combined)
        for i in range(0, len(row), 1 << 15):
            yield pa.RecordBatch.from_arrays([pa.array(shard[i : i + (1 << 15)]), _as_lists(s[row[i : i + (1 << 15)]])], names=["shard", "sig"])


def signature_forest(s: np.ndarray, k: int, radius: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges, as row numbers, that connect what is connected by links through fingerprint ``k``.

    Rows go by their distance from the first one; a row meets only those whose
    distance is at most ``radius`` more.  Whole signatures are compared only for
    pairs that are not connected yet.
    """
    n = len(s)
    shell = np.bitwise_count(s[:, k] ^ s[0, k]).astype(np.int64)
    order = np.argsort(shell, kind="stable")
    p, shell = s[order], shell[order]
    one = np.ascontiguousarray(p[:, k])
    last = np.searchsorted(shell, shell + radius, "right")
    label, i = np.arange(n), 0
    while i < n:
        j = min(n, i + max(1, (_PAIRS_AT_ONCE >> 2) // (n - i)))
        a, b = np.nonzero(np.bitwise_count(one[i:j, None] ^ one[None, i : int(last[j - 1])]) <= radius)
        a, b = a[a < b] + i, b[a < b] + i
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            open_ = label[x] != label[y]
            x, y = x[open_], y[open_]
            near = np.bitwise_count(p[x] ^ p[y]).sum(1, dtype=np.int64) <= bits
            x, y = x[near], y[near]
            while len(x):
                lx, ly = label[x], label[y]
                np.minimum.at(label, np.maximum(lx, ly), np.minimum(lx, ly))
                while (label[label] != label).any():
                    label = label[label]
                open_ = label[x] != label[y]
                x, y = x[open_], y[open_]
        i = j
    moved = np.flatnonzero(label != np.arange(n))
    return order[moved], order[label[moved]]


def _signature_edges(batches: Iterator[pa.RecordBatch], k: int, radius: int, bits: int) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, "shard"):
        s, keys = _from_lists(table["sig"]), table["shard"].to_numpy()
        bounds = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a > 1:
                x, y = signature_forest(s[a:b], k, radius, bits)
                if len(x):
                    yield pa.RecordBatch.from_arrays([_as_lists(s[a:b][x]), _as_lists(s[a:b][y])], names=["a", "b"])


def signature_links(points: DataFrame, radius: int = NEAR_RADIUS, bits: int = NEAR_BITS, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> DataFrame:
    """(a, b): a spanning set of the links between the different signatures (sig) of ``points``."""
    spark, out = points.sparkSession, None
    few = with_partners(points, radius, leaf_rows, wide)
    n = few.count()
    for k in range(SEARCHED):
        shared = spark.sparkContext.broadcast(trees(few.select(F.col("sig")[k].alias("fp")), radius, n, leaf_rows, wide))
        dealt = few.mapInArrow(lambda it, k=k, shared=shared: _route_signatures(it, shared, k), "shard long, sig array<long>")
        dealt = dealt.repartition(partitions(spark), "shard").sortWithinPartitions("shard")
        found = dealt.mapInArrow(lambda it, k=k: _signature_edges(it, k, radius, bits), "a array<long>, b array<long>")
        out = found if out is None else out.union(found)
    return out


def deduplicated(docs: DataFrame, radius: int = NEAR_RADIUS, bits: int = NEAR_BITS, leaf_rows: int = LEAF_ROWS, wide: int = WIDE) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, by signatures: that of the least doc_id, null after all others, of the least hash of its text, and of those equal in both any.

    Null and empty texts are near-duplicates of each other; very long texts
    count whole; rows that share a doc_id but not a text are told apart;
    columns come along whatever their names; an empty table gives an empty
    result.  Texts are shuffled once: rows of one doc_id and text become one on
    the way, and the keys that stay meet them where they are.
    """
    rows = docs.select("doc_id", "text", row_key(docs, ["doc_id", "text"]).alias("key"))
    sigs = rows.mapInArrow(_signatures, "doc_id long, key string, sig array<long>")
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), "key")
    points = cut(sigs.groupBy("sig").agg(F.min(first).alias("first")))
    groups = components(signature_links(points, radius, bits, leaf_rows, wide)).withColumnRenamed("node", "sig")
    rooted = points.join(groups, "sig", "left").withColumn("component", F.coalesce("component", "sig"))
    keep = rooted.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.key").alias("key"))
    each = docs.select(row_key(docs, ["doc_id", "text"]).alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).groupBy("key").agg(F.first("doc").alias("doc"))
    return each.join(cut(keep), "key", "left_semi").select("doc.*")
