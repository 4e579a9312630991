"""Quality rules whose cutoffs come from quantile sketches per language and source.

Each document gets integer measures.  A sketch of a measure is a table of
counts of its log-linear buckets (32 to an octave, so within 1/32 of the true
quantile), and merging sketches is adding counts: Spark's partial aggregation
does it for each (language, source), and sums of those are the sketches of the
language and of everything, which stand in for groups of fewer than
``min_group`` documents.  The cutoffs are fences around the quartiles, joined
back to the documents.  A fence is never nearer than a few single events
(one symbol, one repeated line) in a short document of the group, whose length
is read from a sketch as well; no cutoff of a measure is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fundalake.llm.common import Words, chunks, cut, mix, windows

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WIDTH = 5
SYMBOLS = b"#*$%&|<>"
MIN_GROUP = 100
FENCE = 3
MEASURES = ("symbols", "dup_lines", "word_len")
#: Measures that count events for each 1000 words.
RATES = ("symbols", "dup_lines")

_symbol = np.zeros(256, bool)
_symbol[list(SYMBOLS)] = True
_point = np.ones(256, bool)
_point[0x80:0xC0] = False
_point[list(b" \t\n\x0b\x0c\r")] = False


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, raw, at in chunks(batches, "text"):
        w = Words(raw, at)
        count = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[raw])])[at])  # noqa: E731, B023
        grams, starts, doc = windows(w.hashes, REPEAT_WIDTH), w.starts(REPEAT_WIDTH), w.doc()
        _, which, often = np.unique(grams[starts] ^ mix(doc[starts].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
        mark = np.zeros(len(w) + 1, np.int64)
        twice = starts[often[which] > 1] if len(starts) else starts
        mark[twice] += 1
        mark[twice + REPEAT_WIDTH] -= 1
        covered = np.concatenate([[0], np.cumsum(np.cumsum(mark[:-1]) > 0)])[w.first]
        data, cuts, dup = raw.tobytes(), at.tolist(), []
        for a, b in zip(cuts, cuts[1:]):
            lines = [x for x in data[a:b].split(b"\n") if x.strip()]
            dup.append(len(lines) - len(set(lines)))
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), *[pa.array(np.asarray(x, np.int64)) for x in (np.diff(w.first), count(_point), count(_symbol), dup, np.diff(covered))]], names=["doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])


def measures(docs: DataFrame) -> DataFrame:
    """Counts of each whole text, and base_failed."""
    out = docs.select("doc_id", "text", "lang", "source").mapInArrow(_measure, "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def bucket(x) -> F.Column:
    """Log-linear bucket of a number from 0 up: exact below 64, then 32 to an octave."""
    shift = F.greatest(F.length(F.bin(x)) - 6, F.lit(0))
    return shift.cast("long") * 32 + F.expr("shiftright(_x, greatest(length(bin(_x)) - 6, 0))")


def bucket_floor(b) -> F.Column:
    """The least number in a bucket."""
    return F.when(b < 64, b).otherwise(F.expr("shiftleft(_b - ((_b - 32) div 32) * 32, cast((_b - 32) div 32 as int))"))


def sketches(long: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n) from rows (lang, source, measure, _x)."""
    return long.groupBy("lang", "source", "measure", bucket(F.col("_x")).alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    return sketch.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """(keys, measure, total, q1, q3) read from sketches; one row per group, and a window over at most some hundred buckets."""
    w = W.partitionBy(*keys, "measure")
    run = sketch.withColumn("run", F.sum("n").over(w.orderBy("bucket"))).withColumn("total", F.sum("n").over(w)).withColumnRenamed("bucket", "_b")
    at = lambda p: F.min(F.when(F.col("run") * 4 >= F.col("total") * p, bucket_floor(F.col("_b"))))
    return run.groupBy(*keys, "measure").agg(F.first("total").alias("total"), at(1).alias("q1"), at(3).alias("q3"))


def _wide(q: DataFrame, *keys: str) -> DataFrame:
    """The fences of the measures side by side: FENCE spreads beyond the quartiles; for a rate, a spread is one event in a document of the first quartile's length at least."""
    pick = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    q = q.groupBy(*keys).agg(F.max("total").alias("total"), *[pick(m, c).alias(f"{m}_{c}") for m in (*MEASURES, "length") for c in ("q1", "q3")])
    for m in MEASURES:
        q1, q3 = F.col(f"{m}_q1"), F.col(f"{m}_q3")
        spread = F.greatest(q3 - q1, F.expr(f"{m}_q3 div 8") + 1, F.expr("1000 div length_q1") if m in RATES else F.lit(0).cast("long"))
        q = q.withColumn(f"{m}_low", q1 - FENCE * spread).withColumn(f"{m}_high", q3 + FENCE * spread)
    return q.select(*keys, "total", *[f"{m}_{c}" for m in MEASURES for c in ("low", "high")])


def verdicts(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """The measures, base_failed and kept of each row of ``docs``.

    Null and empty texts have no words and fail; very long texts are measured
    whole.  Null languages and sources
    are groups of their own.  Repeated rows count as often as they are there;
    other columns are ignored; an empty table gives an empty result.
    """
    base = cut(measures(docs))
    n = F.col("n_words")
    of = {"symbols": F.expr("1000 * n_symbols div n_words"), "dup_lines": F.expr("1000 * n_dup_lines div n_words"), "word_len": F.expr("100 * word_chars div n_words")}
    good = base.filter(~F.col("base_failed") & (n > 0))
    long = good.select("lang", "source", F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), x.alias("_x")) for m, x in (of | {"length": n}).items()])).alias("m")).select("lang", "source", "m.*")
    fine = cut(sketches(long))
    levels = [("own", ["lang", "source"]), ("tongue", ["lang"]), ("all", [])]
    out = base
    for name, keys in levels:
        fences = _wide(quartiles(merged(fine, *keys), *keys), *keys)
        if keys:
            fences = fences.filter(F.col("total") >= min_group)
        fences = fences.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], *[F.col(c).alias(f"{name}_{c}") for c in fences.columns if "_" in c])
        on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{name}_{k}")) for k in keys], F.lit(True))
        out = out.join(fences, on, "left") if keys else out.join(F.broadcast(fences), on, "left")  # one row
    fence = lambda m, c: F.coalesce(*[F.col(f"{name}_{m}_{c}") for name, _ in levels])
    ok = (of["symbols"] <= fence("symbols", "high")) & (of["dup_lines"] <= fence("dup_lines", "high")) & of["word_len"].between(fence("word_len", "low"), fence("word_len", "high"))
    kept = F.when(F.col("base_failed"), False).otherwise(F.coalesce(ok, F.lit(False)))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
