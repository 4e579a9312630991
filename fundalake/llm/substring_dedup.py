"""Repeated passages, found with prefix-partitioned suffix trees.

A window is ``width`` consecutive words of one text; a word goes if a window
over it is repeated anywhere.

Which suffixes.  The suffix that starts at a window is dealt out by a prefix of
variable length: the words up to and including the window's *anchor*, the
8-word sequence in it with the least hash (the leftmost of equals).  Equal
windows have equal anchors at equal places, hence equal prefixes.  Anchors are
7 % of the positions.  They are counted over the whole corpus first, with
partial sums, and only suffixes whose anchor is there twice are built at all.
Texts that are equal as a whole are counted beforehand: everything in them is
repeated, and one of them stands for all in the trees.

Trees.  An anchor's suffixes overlap, so they travel together as one slice of
word hashes.  In each task the trees of the groups at hand grow from the top,
a level of words at a time; a branch with a single suffix is a leaf and is
dropped.  Nodes at depth ``width`` are the repeats.

The repeated anchors go to the tasks as an array if there are at most
``set_rows`` of them, and otherwise in a join that brings each text its own;
so do the texts that are there more than once.

Size.  A group with more than ``group_rows`` slices is split further by longer
prefixes, up to the whole window.  Such a prefix is itself the path to a node of
depth ``width``, which is a repeat if two suffixes pass it; so the subtrees of
these groups are their prefixes and counts, added up with partial sums.  The
repeated ones go to the tasks that hold the slices, or, beyond ``set_rows``, to
a salted join, so that a passage that a third of all texts share is dealt out
like any other.  Nothing is capped or left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fundalake.llm.common import Words, chunks, cut, mix, partitions, windows
from fundalake.llm.simhash import sorted_groups

WIDTH = 35
ANCHOR = 8
GROUP_ROWS = 4096
#: Most anchors, or repeated texts, that are sent to the tasks (8 and 16 bytes each).
SET_ROWS = 1 << 22
#: Parts of a hot window in the join.
SALTS = 16
_LEVEL = 5


def _anchors(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the anchor-long sequences; the starts of all windows; each one's anchor position."""
    grams = windows(h, ANCHOR)
    n = len(h) - width + 1
    if n <= 0:
        return grams, np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, at, have = grams, np.arange(len(grams)), 1
    reach = width - ANCHOR + 1
    while have < reach:
        step = min(have, reach - have)
        left, right = least[:-step], least[step:]
        keep = left <= right
        least, at = np.where(keep, left, right), np.where(keep, at[:-step], at[step:])
        have += step
    starts = np.flatnonzero(doc[:n] == doc[width - 1 :])
    return grams, starts, at[starts]


def _runs(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds in ``starts`` of the runs of neighbouring windows with one anchor."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return first, np.append(first[1:], len(starts))


def _stand_in(batches: Iterator[pa.RecordBatch], copied) -> Iterator[pa.RecordBatch]:
    """The rows without the copies that another row stands for; ``copied``: sorted keys of texts with copies, and the doc_id that stays."""
    if copied is None:
        yield from batches
        return
    keys, stays = copied.value
    for batch in batches:
        key = batch.column(1).to_numpy(zero_copy_only=False)
        doc = batch.column(0).fill_null(_NO_DOC).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(keys, key), max(0, len(keys) - 1))
        gone = (keys[at] == key) & (stays[at] != doc) if len(keys) else np.zeros(len(key), bool)
        yield batch.filter(pa.array(~gone)) if gone.any() else batch


_NO_DOC = -(1 << 63)


def _count_anchors(batches: Iterator[pa.RecordBatch], width: int, copied) -> Iterator[pa.RecordBatch]:
    for part, raw, cuts in chunks(_stand_in(batches, copied), "text"):
        w = Words(raw, cuts)
        doc = w.doc()
        grams, starts, at = _anchors(w.hashes, doc, width)
        first, _ = _runs(starts, at)
        at = at[first]
        d, g = doc[at], grams[at]
        order = np.lexsort((g, d))
        d, g = d[order], g[order]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (g[1:] != g[:-1])]) if len(g) else np.zeros(0, bool)
        lead = np.flatnonzero(new)
        runs = np.diff(np.append(lead, len(g)))
        row = pa.array(d[lead])
        yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(g[lead].view(np.int64)), pa.array(runs)], names=["doc_id", "_key", "anchor", "runs"])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _slices(batches: Iterator[pa.RecordBatch], width: int, copied, repeated) -> Iterator[pa.RecordBatch]:
    """A row for each run of windows with a repeated anchor (hot: for each window).

    ``repeated``: sorted arrays of the cold and the hot anchors; None: each text has its own list.
    """
    for part, raw, cuts in chunks(_stand_in(batches, copied), "text"):
        w = Words(raw, cuts)
        doc = w.doc()
        grams, starts, at = _anchors(w.hashes, doc, width)
        first, after = _runs(starts, at)
        if repeated is not None:
            is_cold, is_hot = (_among(grams[at[first]], x) for x in repeated.value)
        else:
            lists = part.column(part.schema.get_field_index("anchors"))
            flat = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
            salt = lambda d: mix(d.astype(np.uint64) + np.uint64(1))
            wanted = flat.field("anchor").to_numpy(zero_copy_only=False).view(np.uint64) ^ salt(owner)
            hot = flat.field("hot").to_numpy(zero_copy_only=False).astype(bool)
            have = grams[at[first]] ^ salt(doc[at[first]])
            is_hot, is_cold = np.isin(have, wanted[hot]), np.isin(have, wanted[~hot])
        base = w.first[doc[starts]] if len(starts) else starts
        ids, keys = part.column(0), part.column(1)

        a, b = first[is_cold], after[is_cold]
        if len(a):
            s, e = starts[a], starts[b - 1] + width
            size = e - s
            take = np.repeat(s - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            data = pa.py_buffer(w.hashes[take].tobytes())
            offsets = np.concatenate([[0], np.cumsum(size * 8)]).astype(np.int64)
            content = pa.Array.from_buffers(pa.large_binary(), len(a), [None, pa.py_buffer(offsets.tobytes()), data]).cast(pa.binary())
            row = pa.array(doc[s])
            none = pa.nulls(len(a), pa.int64())
            yield pa.RecordBatch.from_arrays([ids.take(row), keys.take(row), pa.array(grams[at[a]].view(np.int64)), pa.array(s - base[a]), pa.array(at[a] - s), pa.array(b - a), content, none, none], names=_SLICE)
        if is_hot.any():
            pick = np.concatenate([np.arange(x, y) for x, y in zip(first[is_hot], after[is_hot])])
            s = starts[pick]
            row = pa.array(doc[s])
            zero = np.zeros(len(s), np.int64)
            one, two = windows(w.hashes, width)[s], windows(mix(w.hashes + np.uint64(0x5851F42D4C957F2D)), width)[s]
            yield pa.RecordBatch.from_arrays([ids.take(row), keys.take(row), pa.nulls(len(s), pa.int64()), pa.array(s - base[pick]), pa.array(zero), pa.array(zero + 1), pa.nulls(len(s), pa.binary()), pa.array(one.view(np.int64)), pa.array(two.view(np.int64))], names=_SLICE)


_SLICE = ["doc_id", "_key", "anchor", "start", "lead", "n", "content", "w1", "w2"]
_SLICE_TYPE = "doc_id long, _key long, anchor long, start long, lead long, n long, content binary, w1 long, w2 long"


def deep_nodes(group: np.ndarray, at: np.ndarray, words: np.ndarray, width: int) -> np.ndarray:
    """Which of the suffixes at ``at`` pass a node of depth ``width`` with another suffix of their group.

    The trees of all groups grow together from the top, _LEVEL words at a time.
    """
    alive, node = np.arange(len(at)), group
    depth = 0
    while depth < width and len(alive):
        step = min(_LEVEL, width - depth)
        edge = windows(words, step)[at[alive] + depth]
        order = np.lexsort((edge, node))
        n, e = node[order], edge[order]
        new = np.concatenate([[True], (n[1:] != n[:-1]) | (e[1:] != e[:-1])])
        child = np.cumsum(new) - 1
        branch = np.bincount(child)[child] > 1
        alive, node = alive[order][branch], child[branch]
        depth += step
    return alive


def _repeats(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for table in sorted_groups(batches, "anchor"):
        table = table.combine_chunks()
        anchor, start, lead, n = (table[c].to_numpy() for c in ("anchor", "start", "lead", "n"))
        content = table["content"].combine_chunks() if isinstance(table["content"], pa.ChunkedArray) else table["content"]
        content = content.cast(pa.large_binary())
        offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
        words = np.frombuffer(content.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64)
        head = (offsets[:-1] - offsets[0]) // 8
        row = np.repeat(np.arange(len(n)), n)
        j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        group = np.unique(anchor, return_inverse=True)[1][row] * (width + 1) + (lead[row] - j)
        hit = np.sort(deep_nodes(group, head[row] + j, words, width))
        if not len(hit):
            continue
        r, s = row[hit], start[row[hit]] + j[hit]
        new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)]))
        last = np.append(new[1:], len(r)) - 1
        pick = pa.array(r[new])
        yield pa.RecordBatch.from_arrays([_flat(table["doc_id"]).take(pick), _flat(table["_key"]).take(pick), pa.array(s[new]), pa.array(s[last] + width)], names=["doc_id", "_key", "from", "to"])


def _flat(column: pa.ChunkedArray) -> pa.Array:
    out = column.combine_chunks()
    return out.chunk(0) if isinstance(out, pa.ChunkedArray) else out


def _hot_spans(batches: Iterator[pa.RecordBatch], width: int, again) -> Iterator[pa.RecordBatch]:
    """Spans of the neighbouring windows that are among ``again``: two arrays, sorted by both."""
    one, two = again.value
    for batch in batches:
        w1, w2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("w1", "w2"))
        lo, hi = np.searchsorted(one, w1), np.searchsorted(one, w1, "right")
        hit = np.zeros(len(w1), bool)
        for i in range(int((hi - lo).max(initial=0))):  # more than one only where half of the hash collides
            some = np.flatnonzero(lo + i < hi)
            hit[some] |= two[lo[some] + i] == w2[some]
        key, start = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("_key", "start"))
        doc = batch.column(0).fill_null(_NO_DOC).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(hit)
        if not len(at):
            continue
        k, d, s = key[at], doc[at], start[at]
        new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1]) | (s[1:] != s[:-1] + 1)]))
        last = np.append(new[1:], len(s)) - 1
        row = pa.array(at[new])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), pa.array(k[new]), pa.array(s[new]), pa.array(s[last] + width)], names=["doc_id", "_key", "from", "to"])


def _cut_out(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for part, raw, cuts in chunks(batches, "text"):
        data, at = raw.tobytes(), cuts.tolist()
        whole = part.column(2).to_pylist()
        spans = part.column(3)
        flat, lengths = spans.flatten(), spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        a, b = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("from", "to"))
        ends = np.cumsum(lengths)
        texts, n_words, n_removed = [], [], []
        for d in range(part.num_rows):
            words = data[at[d] : at[d + 1]].split()
            n = len(words)
            if whole[d] and n >= width:
                kept = []
            elif lengths[d]:
                mark = np.zeros(n + 1, np.int64)
                lo, hi = int(ends[d] - lengths[d]), int(ends[d])
                np.add.at(mark, a[lo:hi], 1)
                np.add.at(mark, b[lo:hi], -1)
                kept = [words[i] for i in np.flatnonzero(np.cumsum(mark[:n]) == 0).tolist()]
            else:
                kept = words
            texts.append(b" ".join(kept))
            n_words.append(n)
            n_removed.append(n - len(kept))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], names=["doc", "text", "kept_text", "n_words", "n_removed"])


def repeated_spans(docs: DataFrame, width: int = WIDTH, group_rows: int = GROUP_ROWS, set_rows: int = SET_ROWS) -> DataFrame:
    """(doc_id, _key, _whole, _spans): what is repeated in each text that has repeats; _key is a hash of the text.

    _whole: the text as a whole is there more than once; then _spans is null.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    base = docs.select("doc_id", F.xxhash64(F.lit(1), text).alias("_key"), text.alias("text"))
    copies = cut(base.groupBy("_key", F.xxhash64("text").alias("_key2")).agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")))

    many = copies.filter("n > 1")
    copied = None
    if many.count() <= set_rows:
        t = many.select("_key", F.coalesce("doc_id", F.lit(_NO_DOC)).alias("doc_id")).orderBy("_key").toArrow()
        copied = spark.sparkContext.broadcast((t["_key"].to_numpy(), t["doc_id"].to_numpy()))

    anchors = base.mapInArrow(lambda it: _count_anchors(it, width, copied), "doc_id long, _key long, anchor long, runs long")
    counted = anchors.groupBy("anchor").agg(F.sum("runs").alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi"), F.max("runs").alias("runs"))
    twice = cut(counted.filter("runs > 1 or lo <> hi").select("anchor", (F.col("n") > group_rows).alias("hot")))
    if twice.count() <= set_rows:
        t = twice.toArrow()
        anchor, is_hot = t["anchor"].to_numpy().view(np.uint64), t["hot"].to_numpy().astype(bool)
        repeated = spark.sparkContext.broadcast((np.sort(anchor[~is_hot]), np.sort(anchor[is_hot])))
        texts = base
    else:
        repeated = None
        stands = copies.select("doc_id", "_key")
        lists = anchors.select("doc_id", "_key", "anchor").join(twice, "anchor").groupBy("doc_id", "_key").agg(F.collect_set(F.struct("anchor", "hot")).alias("anchors"))
        lists = lists.join(stands, (lists.doc_id.eqNullSafe(stands.doc_id)) & (lists._key == stands._key), "left_semi")
        texts = base.alias("b").join(lists.alias("l"), F.col("b.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("b._key") == F.col("l._key"))).select("b.doc_id", "b._key", "b.text", "l.anchors")
    slices = cut(texts.mapInArrow(lambda it: _slices(it, width, copied, repeated), _SLICE_TYPE))

    cold = slices.filter("anchor is not null").repartition(partitions(spark), "anchor").sortWithinPartitions("anchor")
    spans = cold.mapInArrow(lambda it: _repeats(it, width), "doc_id long, _key long, `from` long, `to` long")
    hot = slices.filter("anchor is null").select("doc_id", "_key", "start", "w1", "w2")
    again = cut(hot.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").drop("n"))
    if again.count() <= set_rows:
        t = again.orderBy("w1", "w2").toArrow()
        sent = spark.sparkContext.broadcast((t["w1"].to_numpy(), t["w2"].to_numpy()))
        more = hot.mapInArrow(lambda it: _hot_spans(it, width, sent), "doc_id long, _key long, `from` long, `to` long")
    else:
        salted = again.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        more = hot.withColumn("salt", F.pmod(F.xxhash64("_key", "start"), F.lit(SALTS)).cast("int")).join(salted, ["w1", "w2", "salt"]).select("doc_id", "_key", F.col("start").alias("from"), (F.col("start") + width).alias("to"))
    spans = spans.unionByName(more)
    found = spans.groupBy("doc_id", "_key").agg(F.collect_list(F.struct("from", "to")).alias("_spans"))

    copied_keys = many.select("_key", F.lit(True).alias("_whole")).distinct()
    whole = base.select("doc_id", "_key").join(copied_keys, "_key").distinct()
    single = found.join(whole.select("doc_id", "_key"), found.doc_id.eqNullSafe(whole.doc_id) & (found._key == whole._key), "left_anti")
    none = F.lit(None).cast("array<struct<from:long,to:long>>")
    return whole.select("doc_id", "_key", "_whole", none.alias("_spans")).unionByName(single.select("doc_id", "_key", F.lit(False).alias("_whole"), "_spans"))


def _judged(docs: DataFrame, width: int, group_rows: int, set_rows: int) -> DataFrame:
    """(doc, text, kept_text, n_words, n_removed): a row per row of ``docs``; doc holds its other columns."""
    spans = repeated_spans(docs, width, group_rows, set_rows)
    key = F.xxhash64(F.lit(1), F.coalesce("text", F.lit("")))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("doc"), "text", key.alias("_key")).alias("d")
    joined = left.join(spans.alias("s"), F.col("d.doc.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d._key") == F.col("s._key")), "left")
    joined = joined.select("d.doc", "d.text", F.coalesce("s._whole", F.lit(False)).alias("_whole"), F.col("s._spans").alias("_spans"))
    kind = StructType([joined.schema["doc"], joined.schema["text"], StructField("kept_text", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())])
    return joined.mapInArrow(lambda it: _cut_out(it, width), kind)


def _column(name: str) -> F.Column:
    return F.col("text") if name == "text" else F.col(f"doc.`{name}`")


def without_repeats(docs: DataFrame, width: int = WIDTH, group_rows: int = GROUP_ROWS, set_rows: int = SET_ROWS) -> DataFrame:
    """``docs`` with kept_text (the kept words, one space between), n_words and n_removed.

    Null and empty texts have no word.  A very long text is read whole.
    Repeated rows are copies of each other, also under one doc_id; a null
    doc_id is a doc_id like any other.  Extra columns come along (those named
    kept_text, n_words or n_removed are replaced); an empty table gives an
    empty result.
    """
    out = _judged(docs, width, group_rows, set_rows)
    return out.select(*[_column(c).alias(c) for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")], "kept_text", "n_words", "n_removed")


def applied(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` with the repeats cut out of their texts; texts without any stay as they are, and documents of which nothing is left go.

    Null and empty texts stay; repeated rows with ``width`` words or more go,
    all of them; n_chars, if there is such a column, follows the text; other
    columns come along whatever their names.
    """
    touched = F.col("n_removed") > 0
    kept = _judged(docs, width, GROUP_ROWS, SET_ROWS).filter(~touched | (F.col("n_removed") < F.col("n_words")))
    new = {"text": F.when(touched, F.col("kept_text")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(touched, F.length("kept_text")).otherwise(F.col("doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return kept.select(*[new.get(c, _column(c)).alias(c) for c in docs.columns])
