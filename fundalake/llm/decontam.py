"""Benchmark decontamination by spaced seeds.

Texts become lower-case tokens (letters and digits; other ASCII characters
separate).  A spaced seed is a hash of the tokens that a fixed mask selects
from neighbours; the tokens between do not count, so that a substitution there
is tolerated.  The seeds of the benchmark are looked up among those of the
documents, and around each hit the item is laid over the document on that
diagonal: the longest stretch of it that is similar enough counts.

The masks miss nothing.  A similar stretch of 26 tokens or more has a similar
half, so one of at most 25 is there, with a fifth of its tokens changed at most.
It has 10 neighbours of which at most 2 are changed, or (3 changes amid 15) 5
unchanged ones.  Cut into 3, 2, 2 and 3 tokens, two of the four parts of the 10
are whole, which is one of ``MASKS``.  Items of 5 to 7 tokens have one change at
most: three neighbours are whole, or all but the middle of 5.

Items of fewer than 5 tokens have no seed: they overlap a text that is the item
and nothing else.

Join.  The seeds of both sides are rows, joined by seed; a document's rows are
sent only if a filter of fixed size, made of the benchmark's seeds, does not
rule them out.  A text's seed is sent once, wherever it stands, and a hit is a
text and an item with a common seed, so that texts and items that repeat one
phrase meet once and not on every diagonal.  The diagonals are found again in
the task that has the text, and followed until no longer stretch can come.
Texts are named by 128 bits of hash, so copies of a text share their hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import Words, chunks, cut, mix, small

#: 1: the token counts.
MASKS = ("1111", "1110011", "1100111", "1110000111")
SHORT_MASKS = ("111", "11011")
SHORT = 8
MIN_TOKENS = 5
#: How many tokens of the item must be overlapped; 0.8 of them must be equal (the masks and the 1 and -4 below rest on that).
MIN_OVERLAP = 13
#: Tokens that are compared at a time.
CELLS = 1 << 20
#: About how many items a row of a text carries; a text that meets more has several rows.
ITEMS_PER_ROW = 1 << 12
#: Each of the filter's two tables has 2 ** TABLE_BITS bits.
TABLE_BITS = 25

_separator = np.ones(256, bool)
_separator[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = False
_separator[0x80:] = False
_MULTIPLIERS = [pow(0xD1342543DE82EF95, i + 1, 1 << 64) for i in range(max(map(len, MASKS)))]


def _seeds(h: np.ndarray, mask: str, salt: int) -> np.ndarray:
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, salt, np.uint64)
    for i, c in enumerate(mask):
        if c == "1":
            out += h[i : i + n] * np.uint64(_MULTIPLIERS[i])
    return mix(out)


def tokens(column: pa.Array) -> Words:
    import pyarrow.compute as pc

    from fundalake.llm.common import text_buffers

    return Words(*text_buffers(pc.utf8_lower(column)), _separator)


def masks_of(n_tokens: int) -> list[str]:
    """The masks for an item of so many tokens."""
    return list(MASKS) if n_tokens >= SHORT else list(SHORT_MASKS) if n_tokens >= MIN_TOKENS else []


_ALL_MASKS = [*MASKS, *SHORT_MASKS]
_WHOLE = 1 << 32


def item_seeds(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of an item, and where in it they begin."""
    if 0 < len(h) < MIN_TOKENS:
        return whole_seeds(h, np.array([0, len(h)])), np.zeros(1, np.int64)
    found = [_seeds(h, m, _ALL_MASKS.index(m)) for m in masks_of(len(h))]
    return (np.concatenate(found), np.concatenate([np.arange(len(s)) for s in found])) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def whole_seeds(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The seed of each text h[first[i]:first[i + 1]] as a whole; the texts are shorter than MIN_TOKENS."""
    n = np.diff(first)
    out = n.astype(np.uint64) + np.uint64(_WHOLE)
    for i in range(MIN_TOKENS - 1):
        has = n > i
        out[has] += h[first[:-1][has] + i] * np.uint64(_MULTIPLIERS[i])
    return mix(out)


def _flat_tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes in a binary column, and each row's bounds in them."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(np.uint64) if data is not None and at[-1] > at[0] else np.zeros(0, np.uint64)
    return flat, (at - at[0]) // 8


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, _, _ in chunks(batches, "text"):
        w = tokens(part.column(2).cast(pa.large_string()))
        n = np.diff(w.first)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array([w.hashes[a:b].tobytes() for a, b in zip(w.first, w.first[1:])], pa.binary())], names=["item", "item_id", "n", "tokens"])


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, at = _flat_tokens(batch.column(1))
        for item, a, b in zip(batch.column(0).to_pylist(), at, at[1:]):
            seed = np.unique(item_seeds(flat[a:b])[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seed), item)), pa.array(seed.view(np.int64))], names=["item", "seed"])


class Filter:
    """Two bit tables that hold all seeds of the benchmark."""

    def __init__(self, table: np.ndarray, word: np.ndarray, bits: np.ndarray) -> None:
        self.words = np.zeros((2, 1 << (TABLE_BITS - 6)), np.uint64)
        self.words[table, word] = bits.view(np.uint64)

    def may_have(self, seed: np.ndarray) -> np.ndarray:
        """The indices of the seeds that may be there."""
        at = np.arange(len(seed))
        for table, x in enumerate((seed >> np.uint64(64 - TABLE_BITS), seed & np.uint64((1 << TABLE_BITS) - 1))):
            x = x[at]
            at = at[(self.words[table, (x >> np.uint64(6)).astype(np.int64)] >> (x & np.uint64(63))) & np.uint64(1) != 0]
        return at


def _filter(seeds: DataFrame) -> Filter:
    """At most 2 ** (TABLE_BITS - 5) rows come to the driver, whatever the benchmark's size."""
    low = (1 << TABLE_BITS) - 1
    places = F.array(*[F.struct(F.lit(i).alias("table"), x.alias("x")) for i, x in enumerate((F.shiftrightunsigned("seed", 64 - TABLE_BITS), F.col("seed").bitwiseAND(low)))])
    rows = seeds.select(F.explode(places).alias("p")).select("p.*").groupBy("table", F.shiftright("x", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(x & 63 as int)))").alias("bits"))
    t = rows.toArrow()
    return Filter(t["table"].to_numpy(), t["word"].to_numpy(), t["bits"].to_numpy())


def _doc_seeds(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    known: Filter = shared.value
    for part, _, _ in chunks(batches, "text"):
        w = tokens(part.column(2).cast(pa.large_string()).fill_null(""))
        doc, seeds, rows = w.doc(), [], []
        for k, m in enumerate(_ALL_MASKS):
            starts = w.starts(len(m))
            if len(starts):
                s = _seeds(w.hashes, m, k)[starts]
                maybe = known.may_have(s)
                seeds.append(s[maybe])
                rows.append(doc[starts[maybe]])
        n = np.diff(w.first)
        brief = np.flatnonzero((n > 0) & (n < MIN_TOKENS))
        if len(brief):
            inside = np.repeat((n > 0) & (n < MIN_TOKENS), n)
            s = whole_seeds(w.hashes[inside], np.concatenate([[0], np.cumsum(n[brief])]))
            maybe = known.may_have(s)
            seeds.append(s[maybe])
            rows.append(brief[maybe])
        if seeds:
            seed, row = np.concatenate(seeds), np.concatenate(rows)
            order = np.lexsort((seed, row))
            seed, row = seed[order], row[order]
            once = np.append(True, (seed[1:] != seed[:-1]) | (row[1:] != row[:-1]))[: len(seed)]
            at = pa.array(row[once])
            yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(seed[once].view(np.int64))], names=["k1", "k2", "seed"])


def text_seeds(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All seeds of a text in order, and where in it they begin."""
    found = [_seeds(h, m, k) for k, m in enumerate(_ALL_MASKS)]
    if 0 < len(h) < MIN_TOKENS:
        found.append(whole_seeds(h, np.array([0, len(h)])))
    seed, place = np.concatenate(found), np.concatenate([np.arange(len(s)) for s in found])
    order = np.argsort(seed)
    return seed[order], place[order]


def diagonals(text: tuple[np.ndarray, np.ndarray], n_text: int, item: tuple[np.ndarray, np.ndarray], n_item: int) -> np.ndarray:
    """Where in the text the item begins (before it, if negative) when a seed of both meets, each once and in order."""
    lo, hi = (np.searchsorted(text[0], item[0], side) for side in ("left", "right"))
    met = np.flatnonzero(hi > lo)
    met = met[np.argsort(item[0][met], kind="stable")]
    n, mark, x = hi[met] - lo[met], np.zeros(n_text + n_item + 1, bool), 0
    total = np.cumsum(n)
    while x < len(met):
        y = max(x + 1, int(np.searchsorted(total, total[x] - n[x] + CELLS, "right")))
        i, m = met[x:y], n[x:y]
        place = text[1][np.arange(int(m.sum())) + np.repeat(lo[i] - (np.cumsum(m) - m), m)]
        mark[place - np.repeat(item[1][i], m) + n_item] = True
        x = y
    return np.flatnonzero(mark) - n_item


def overlap(h: np.ndarray, item: np.ndarray, start: np.ndarray) -> tuple[int, int, int] | None:
    """(from, to, equal): the longest stretch of text h that repeats the item on one of the diagonals, and of equals the first by bound and place; None if none is long enough.

    A stretch has at most 5/4 of its diagonal's equal tokens.  The diagonals
    are taken by falling bound until none can beat the longest stretch so far,
    so that one of a repetitive text's many diagonals is enough.
    """
    n, m = len(h), len(item)
    if m < MIN_TOKENS:
        return (0, n, m) if n == m and (h == item).all() else None
    bound, step = np.zeros(len(start), np.int64), max(1, CELLS // m)
    for x in range(0, len(start), step):
        at = start[x : x + step, None] + np.arange(m)
        inside = (at >= 0) & (at < n)
        same = ((h[np.clip(at, 0, n - 1)] == item) & inside).sum(1)
        bound[x : x + step] = np.minimum(inside.sum(1), same * 5 // 4)
    best, found = min(m, MIN_OVERLAP) - 1, None
    for i in np.argsort(-bound, kind="stable").tolist():
        if bound[i] <= best:
            break
        s = int(start[i])
        a, b = max(s, 0), min(s + m, n)
        a, b, same = _longest(h[a:b] == item[a - s : b - s], a)
        if b - a > best:
            best, found = b - a, (a, b, same)
    return found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for part, _, _ in chunks(batches, "text"):
        w = tokens(part.column(2).cast(pa.large_string()))
        lists = part.column(3)
        hit = lists.flatten()
        flat, at = _flat_tokens(hit.field("tokens"))
        ids, first, rows, texts, found = hit.field("item").to_pylist(), 0, [], [], []
        for d, count in enumerate(lists.value_lengths().to_pylist()):
            h = w.hashes[w.first[d] : w.first[d + 1]]
            of_text = text_seeds(h)
            for i in range(first, first + count):
                item = flat[at[i] : at[i + 1]]
                if ids[i] not in known:
                    if len(known) >= ITEMS_PER_ROW:
                        known.clear()
                    known[ids[i]] = item_seeds(item)
                if x := overlap(h, item, diagonals(of_text, len(h), known[ids[i]], len(item))):
                    rows.append(i)
                    texts.append(d)
                    found.append((x[0], x[1], x[1] - x[0], x[2]))
            first += count
        text = pa.array(texts, pa.int64())
        yield pa.RecordBatch.from_arrays([part.column(0).take(text), part.column(1).take(text), hit.field("item").take(pa.array(rows, pa.int64())), *[pa.array([x[k] for x in found], pa.int64()) for k in range(4)]], names=["k1", "k2", "item", "from", "to", "overlap", "equal"])


def _longest(equal: np.ndarray, a: int) -> tuple[int, int, int]:
    """The longest stretch of which 0.8 or more is equal: an equal token gives 1, another costs 4, and the sum is not below 0."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
    high = np.maximum.accumulate(score[::-1])[::-1]
    end = np.searchsorted(-high, -score, "right") - 1
    i = int(np.argmax(end - np.arange(len(score))))
    j = int(end[i])
    return a + i, a + j, int(equal[i:j].sum())


def _keys() -> list[F.Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("decontam"), text).alias("k2")]


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(k1, k2, item, item_id, from, to, overlap, equal): the stretches of different texts that repeat a benchmark item; k1 and k2 name the text.

    A stretch has 13 tokens, or all of a shorter item, of which 0.8 or more are
    equal; a text and an item have one row, the longest.  An item of fewer than 5
    tokens is found only in a text that has no other tokens.  Null and empty
    texts, and those without a letter or digit, match nothing; very long texts
    are read whole; equal items under one item_id are one, and a null item_id
    is an id like any other.
    """
    named = benchmark.select("item_id", "text").filter("text is not null").distinct()
    items = cut(named.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "text").mapInArrow(_items, "item long, item_id long, n long, tokens binary").filter("n > 0"))
    seeds = cut(items.select("item", "tokens").mapInArrow(_item_seeds, "item long, seed long"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter(seeds))
    texts = docs.select(*_keys(), "text")
    sent = texts.mapInArrow(lambda it: _doc_seeds(it, shared), "k1 long, k2 long, seed long").distinct()
    met = sent.join(small(seeds), "seed").select("k1", "k2", "item").distinct()
    parts = F.pmod(F.xxhash64("item"), F.lit(1 + items.count() // ITEMS_PER_ROW))
    per_text = cut(met.join(small(items.select("item", "tokens")), "item").groupBy("k1", "k2", parts.alias("part")).agg(F.collect_list(F.struct("item", "tokens")).alias("hits")).drop("part"))
    found = texts.join(small(per_text), ["k1", "k2"]).select("k1", "k2", "text", "hits").mapInArrow(_verify, "k1 long, k2 long, item long, `from` long, `to` long, overlap long, equal long")
    return cut(found.distinct().join(small(items.select("item", "item_id")), "item"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_overlaps, n_items, longest, item_ids, contaminated) for each row of ``docs``.

    n_overlaps counts the benchmark's different rows that the text repeats, n_items their different ids, null included.
    Repeated rows are reported alike; a null doc_id is one like any other; an
    empty benchmark leaves all documents clean, and an empty table gives an
    empty result; other columns are ignored.  Texts are treated as overlaps() says.
    """
    found = overlaps(docs, benchmark).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.countDistinct(F.struct("item_id")).alias("items"), F.max("overlap").alias("longest"), F.sort_array(F.collect_set("item_id")).alias("ids"))
    joined = docs.select("doc_id", *_keys()).join(found, ["k1", "k2"], "left")
    zero = F.lit(0).cast("long")
    return joined.select("doc_id", F.coalesce("n", zero).alias("n_overlaps"), F.coalesce("items", zero).alias("n_items"), F.coalesce("longest", zero).alias("longest"), F.coalesce("ids", F.array().cast("array<bigint>")).alias("item_ids"), F.col("n").isNotNull().alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that repeat no benchmark item; as overlaps() treats texts, and with columns of any name."""
    found = small(cut(overlaps(docs, benchmark).select("k1", "k2").distinct()))
    rows = docs.select(*_keys(), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return rows.join(found, ["k1", "k2"], "left_anti").select("doc.*")
