"""Periodic runs of words, found octave by octave in overlapping tiles.

A run is a stretch with smallest period q and at least max(6, 4 q) words that
no neighbouring word extends.  With M(q) the positions whose word is that q
places earlier, a run is a maximal interval [a, b) of M(q), less its first q
words: the run itself is [a - q, b).

Tiles.  Periods from S to 2 S - 1, S a power of 2, are an octave.  A text is
dealt out as tiles for each octave, in proportion to S, that overlap by six S
words (a short text is one tile for all its octaves; the lowest octaves of a
long one share their tiles).  What is in a tile is solved without the others.

Boundaries.  Every S-th word of a tile is a boundary c.  For each lag q of the
octave the block of S words that begins at c is compared with that at c - q, by
hashes of blocks; a run has at least three times S matching positions, so it
holds such a block.  From there two Z-functions, of the words behind the block
and, backwards, of those before c, against the same words q places earlier, say
how far the matches go.  They are evaluated by halving, 2 log S comparisons of
block hashes for each pair (c, q) that passed.  A pair whose last q words are a
power of a shorter word is dropped at once: then all of the stretch is, and q is
not its smallest period.  So the fragments are in proportion to the text.

Stitching.  Fragments of a document and period are shuffled together, joined
where they touch, and kept if long enough; the runs of a document then meet its
row.  Texts of over ``long_chars`` characters deal their tiles over all tasks;
those of others are solved where the text is, so no text is shuffled for them.

Hashes have 64 bits, mixed at each doubling.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from fundalake.llm.common import Words, chunks, cut, mix, partitions, small, words_column

LEAST = 6
POWER = 4
#: Words of the tiles that the lowest octaves share.
TILE = 8192
#: Words that are solved at a time, if no tile has more.
GROUP = 1 << 17
#: Characters from which on the tiles of a text are dealt over all tasks.
LONG_CHARS = 1 << 22
_K = np.uint64(0xD6E8FEB86659FD93)
_TILES = "k1 long, k2 long, n long, at long, low int, high int, words binary"
_FRAGMENTS = "k1 long, k2 long, period long, a long, b long"


def tiles_of(n: int, tile: int = TILE) -> Iterator[tuple[int, int, int, int]]:
    """(first word, end, lowest octave, highest octave) of the tiles of a text of n words."""
    if n < LEAST or n < POWER:
        return
    top = (n // POWER).bit_length() - 1
    if n <= tile:
        yield 0, n, 0, top
        return
    shared = min(top, max(0, tile.bit_length() - 4))
    for k, low in [(shared, 0), *((k, k) for k in range(shared + 1, top + 1))]:
        s = 1 << k
        own = tile if low == 0 else 16 * s
        for t in range(0, n, own):
            yield max(0, t - 4 * s), min(n, t + own + 2 * s), low, k


def _tiles(batches: Iterator[pa.RecordBatch], tile: int) -> Iterator[pa.RecordBatch]:
    for part, raw, cuts in chunks(batches, "text"):
        w = Words(raw, cuts)
        k1, k2 = (part.column(i).to_numpy() for i in (0, 1))
        rows, size = [], 0
        for d in range(part.num_rows):
            h = w.hashes[w.first[d] : w.first[d + 1]]
            for a, b, low, high in tiles_of(len(h), tile):
                rows.append((k1[d], k2[d], len(h), a, low, high, h[a:b].tobytes()))
                size += b - a
                if size >= GROUP:
                    yield _rows(rows)
                    rows, size = [], 0
        if rows:
            yield _rows(rows)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["k1", "k2", "n", "at", "low", "high", "words"])


def _least_factors(n: int) -> np.ndarray:
    """The smallest prime factor of each number up to n."""
    out = np.arange(n + 1)
    for i in range(2, int(n**0.5) + 1):
        if out[i] == i:
            step = out[i * i :: i]
            step[step == np.arange(i * i, n + 1, i)] = i
    return out


def _is_power(blocks: list[np.ndarray], k: int, c: np.ndarray, q: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Whether the q words before c are a shorter word, repeated."""
    out = np.zeros(len(c), bool)
    rest = q.copy()
    while (some := np.flatnonzero((rest > 1) & ~out)).size:
        r = factors[rest[some]]
        cs, qs = c[some], q[some]
        p = qs // r
        rest[some] //= r
        for level in (k, k - 1):  # blocks that cover q - p words, from both ends
            b = 1 << level
            use = np.flatnonzero((qs - p >= b) & ((level == k) | (qs - p < 2 * b)))
            if use.size:
                h, at, end, lag = blocks[level], cs[use] - qs[use], cs[use] - b, p[use]
                out[some[use]] = (h[at] == h[at + lag]) & (h[end] == h[end - lag])
    return out


def _reach(blocks: list[np.ndarray], k: int, at: np.ndarray, q: np.ndarray, back: bool) -> np.ndarray:
    """Z-values: for how many words from ``at`` on (backwards: before it) the text is that q places earlier; at most twice the octave."""
    out = np.zeros(len(at), np.int64)
    for level in range(k, -1, -1):
        h, b = blocks[level], 1 << level
        i = at - out - b if back else at + out
        fits = i - q >= 0
        i = np.maximum(i, q)
        out[fits & (h[i] == h[i - q])] += b
    return out


def _merged(group: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals of each group, joined where they touch."""
    if not len(a):
        return group, a, b
    order = np.lexsort((a, group))
    group, a, b = group[order], a[order], b[order]
    rank = np.cumsum(np.concatenate([[0], group[1:] != group[:-1]]))
    span = int(b.max()) + 2
    reach = np.maximum.accumulate(rank * span + b)
    new = np.concatenate([[True], rank[1:] * span + a[1:] > reach[:-1]])
    first = np.flatnonzero(new)
    return group[first], a[first], (reach - rank * span)[np.append(first[1:], len(a)) - 1]


def solve(words: list[np.ndarray], n: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, period, a, b): where the words of some tiles match those a period earlier, in pieces that hold a whole block; bounds in the tile.

    Tiles come by falling highest octave, each ends with a word of its own, so that no match crosses it.
    """
    top = int(high.max())
    sizes = np.array([len(x) for x in words])
    start = 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    used = int(start[-1] + sizes[-1])
    pad = 6 << top
    h = mix(np.arange(used + pad, dtype=np.uint64) + np.uint64(0xA5A5A5A500000000))  # words of their own, where no tile is
    for x, at in zip(words, start):
        h[at : at + len(x)] = x
    blocks = [h]
    for k in range(top):
        b, last = 1 << k, blocks[-1]
        blocks.append(mix(last[:-b] * _K + last[b:]))
    factors = _least_factors(2 << top)
    out = []
    for k in range(int(low.min()), top + 1):
        s, block = 1 << k, blocks[k]
        active = int(np.searchsorted(-high, -k, "right"))
        end = int(start[active - 1] + sizes[active - 1])
        cells = -(-(end - 2 * s) // s)
        if cells <= 0:
            continue
        same = block[1 : 1 + cells * s].reshape(cells, s) == block[2 * s : 2 * s + cells * s : s][:, None]
        hit = np.flatnonzero(same)
        c, q = (hit // s + 2) * s, 2 * s - 1 - hit % s
        tile = np.searchsorted(start, c, "right") - 1
        fit = (c - q >= start[tile]) & (POWER * q <= n[tile]) & (low[tile] <= k)
        c, q, tile = c[fit], q[fit], tile[fit]
        if k:
            prime = ~_is_power(blocks, k, c, q, factors)
            c, q, tile = c[prime], q[prime], tile[prime]
        if len(c):
            a, b = c - _reach(blocks, k, c, q, True), c + s + _reach(blocks, k, c + s, q, False)
            both, a, b = _merged(tile * (4 * s) + q, a, b)
            tile, q = both // (4 * s), both % (4 * s)
            out.append((tile, q, a - start[tile], b - start[tile]))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    return tuple(np.concatenate(x) for x in zip(*out))


def _solved(rows: list[tuple]) -> pa.RecordBatch:
    rows.sort(key=lambda r: -r[5])
    k1, k2, n, at, low, high = (np.array(x, np.int64) for x in list(zip(*rows))[:6])
    words = [np.frombuffer(r[6], np.uint64) for r in rows]
    tile, q, a, b = solve(words, n, low, high)
    sizes = np.array([len(x) for x in words])
    from_before = (a - q <= 0) & (at[tile] > 0)
    goes_on = (b >= sizes[tile]) & (at[tile] + sizes[tile] < n[tile])
    keep = from_before | goes_on | (b - a + q >= np.maximum(LEAST, POWER * q))
    tile, q, a, b = tile[keep], q[keep], a[keep], b[keep]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (k1[tile], k2[tile], q, a + at[tile], b + at[tile])], names=["k1", "k2", "period", "a", "b"])


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:6]]
        for i, row in enumerate(zip(*columns)):
            content = batch.column(6)[i].as_buffer()
            # a tile of one high octave is solved alone
            if rows and (row[4] or rows[0][4] or size + content.size // 8 > GROUP):
                yield _solved(rows)
                rows, size = [], 0
            rows.append((*row, content))
            size += content.size // 8
    if rows:
        yield _solved(rows)


def _keys(doc: str, text: str) -> list[Column]:
    """Two hashes that stand for a document; rows that are equal in both columns share them, and their runs."""
    return [F.xxhash64(F.lit(i), F.col(f"`{doc}`").isNull(), F.col(f"`{doc}`"), F.col(f"`{text}`")).alias(f"k{i}") for i in (1, 2)]


def runs(docs: DataFrame, doc: str = "doc_id", tile: int = TILE, long_chars: int = LONG_CHARS) -> DataFrame:
    """(k1, k2, runs): the runs of each document that has any, array<struct<start, period, length>> in that order."""
    base = docs.select(*_keys(doc, "text"), F.coalesce("text", F.lit("")).alias("text"))
    here = base.filter(F.length("text") <= long_chars).mapInArrow(lambda it: _fragments(_tiles(it, tile)), _FRAGMENTS)
    dealt = base.filter(F.length("text") > long_chars).mapInArrow(lambda it: _tiles(it, tile), _TILES).repartition(partitions(docs.sparkSession))
    found = here.unionByName(dealt.mapInArrow(_fragments, _FRAGMENTS)).distinct()
    along = W.partitionBy("k1", "k2", "period").orderBy("a", "b")
    reached = F.max("b").over(along.rowsBetween(W.unboundedPreceding, -1))
    found = found.withColumn("new", (reached.isNull() | (F.col("a") > reached)).cast("long"))
    found = found.withColumn("piece", F.sum("new").over(along.rowsBetween(W.unboundedPreceding, 0)))
    whole = found.groupBy("k1", "k2", "period", "piece").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    whole = whole.select("k1", "k2", "period", (F.col("a") - F.col("period")).alias("start"), (F.col("b") - F.col("a") + F.col("period")).alias("length"))
    whole = whole.filter(F.col("length") >= F.greatest(F.lit(LEAST), POWER * F.col("period")))
    return whole.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw, cuts in chunks(batches, "text"):
        data, at = raw.tobytes(), cuts.tolist()
        found = part.column(2)
        flat, lengths = found.flatten(), found.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        start, period, length = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "period", "length"))
        ends, texts = np.cumsum(lengths), []
        for d in range(part.num_rows):
            words = data[at[d] : at[d + 1]].split()
            if lengths[d]:
                lo, hi = int(ends[d] - lengths[d]), int(ends[d])
                mark = np.zeros(len(words) + 1, np.int64)
                np.add.at(mark, start[lo:hi] + period[lo:hi], 1)
                np.add.at(mark, start[lo:hi] + length[lo:hi], -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(mark[:-1]) == 0).tolist()]
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), found, pa.array(texts, pa.binary()).cast(pa.string())], names=["row", "text", "runs", "kept_text"])


def collapsed(docs: DataFrame, doc: str = "doc_id", tile: int = TILE, long_chars: int = LONG_CHARS) -> DataFrame:
    """``docs`` with runs, array<struct<start, period, length>> in that order, and kept_text: the words that no run repeats (each run keeps its first period), one space between.

    Null and empty texts have no words: no runs, an empty kept_text.  Very long
    texts are solved whole, tile by tile.  Repeated rows have the same runs, and
    so have equal texts under other ids; a null id is an id like any other.  An
    empty table gives an empty result.  Extra columns come along, whatever their
    names (runs and kept_text are replaced).
    """
    found = small(cut(runs(docs, doc, tile, long_chars)))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row"), "text", *_keys(doc, "text")).alias("d")
    joined = left.join(found.alias("f"), (F.col("d.k1") == F.col("f.k1")) & (F.col("d.k2") == F.col("f.k2")), "left").select("d.row", "d.text", "f.runs")
    out = joined.mapInArrow(_collapse, StructType([joined.schema["row"], joined.schema["text"], joined.schema["runs"], StructField("kept_text", StringType())]))
    none = F.array().cast(joined.schema["runs"].dataType)
    columns = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("runs", "kept_text")]
    return out.select(*columns, F.coalesce("runs", none).alias("runs"), "kept_text")


def best(found: Column) -> Column:
    """The run with the greatest length / period, compared exactly; the first of equals; null without runs."""
    ahead = lambda x, y: x["length"] * y["period"] > y["length"] * x["period"]
    return F.aggregate(F.slice(found, 2, F.greatest(F.size(found), F.lit(1))), F.get(found, F.lit(0)), lambda y, x: F.when(ahead(x, y), x).otherwise(y))


def with_tails(docs: DataFrame) -> DataFrame:
    """``docs`` with the periodic tails of the contract: in a tenth of the documents, by a hash of the id, the words from one on repeat."""
    whole = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.select("doc_id", "text", whole.alias("h"), F.when(whole % 10 == 0, words_column(F.col("text"))).alias("w"))
    g, n = F.floor(F.col("h") / 10), F.size("w")
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice("w", a + 1, p)
    tail = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), 1, n - a)
    new = F.array_join(F.concat(F.slice("w", F.lit(1), a), tail), " ")
    return docs.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), new).otherwise(F.col("text")).alias("text"))
