"""Quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

The symbols are the bytes of lower-case text, so that an n-gram is an exact
number and needs no hash.  All trusted texts are counted.  Counts, continuation
counts, context sums and the probabilities that come of them are Spark
aggregations and joins, sharded by n-gram.

Folds.  A text belongs to one of two folds by its hash, copies to the same, and
there is a model of each fold; a text is scored by the model of the other.  So
no text, trusted or not, is scored by counts of itself.

Scoring.  Texts are packed into chunks of one fold and about ``CHUNK`` bytes, a
table bucketed by chunk.  A chunk asks for the probability of each different
n-gram in it once: these questions are dealt out by the two bytes before the
last, as the model is, and meet its entries there, shard by shard; the answers
are gathered by chunk and joined with the table, which is not shuffled.  What a
task holds is one shard of the model, or one chunk with its answers; what goes
to all tasks is the part for contexts of a byte or none, 66,050 entries a fold
at most.

Perplexities are held against a low and a high quantile of the trusted texts of
the same language and length (to a power of 2): a short text's varies more, and
text that repeats itself can be too easy to predict as well as too hard.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import chunks, cut, fresh_path, partitions

ORDER = 5
FOLDS = 2
#: Shares of the trusted texts that are below the low, and below the high threshold.
QUANTILES = (0.0025, 0.9925)
#: Bytes of text that a chunk has at most, if it has more than one text.
CHUNK = 8 << 20
#: Entries of a model shard; there are as many shards as partitions at least.
SHARD_ENTRIES = 1 << 20
#: A length of a language with fewer trusted texts is held against all lengths, and a language with fewer against all languages.
MIN_TRUSTED = 50
#: Most ids of trusted texts that are sent to the tasks (8 bytes each); beyond it the texts are joined with them.
TRUSTED_ROWS = 1 << 22
_COUNT_BYTES = 4 << 20
_PIECE = 1 << 20


def _padded(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case texts, each with ORDER - 1 zeros before it and one after; and the bounds of each one's ORDER-grams among all."""
    lower = raw.copy()
    upper = (raw >= 65) & (raw <= 90)
    lower[upper] += 32
    n = len(at) - 1
    size = np.diff(at)
    out = np.zeros(len(raw) + n * ORDER, np.uint8)  # ORDER - 1 zeros before and one after
    begin = at[:-1] + np.arange(n) * ORDER
    for a, b, to in zip(at.tolist(), at[1:].tolist(), (begin + ORDER - 1).tolist()):  # an index of all places would take 24 bytes a byte
        out[to : to + b - a] = lower[a:b]
    return out, np.stack([begin, begin + size + 1])


def _grams(padded: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, n-grams, which count) of the padded texts, a piece at a time; those that reach into the next text don't count."""
    n = len(padded) - ORDER + 1
    edge = np.zeros(max(n, 0) + 1, np.int8)
    if n > 0:
        edge[bounds[0]] += 1
        np.add.at(edge, np.minimum(bounds[1], n), -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
    for a in range(0, n, _PIECE):
        b = min(n, a + _PIECE)
        k = np.zeros(b - a, np.uint64)
        for i in range(ORDER):
            k <<= np.uint64(8)
            k |= padded[a + i : b + i]
        yield a, k, inside[a:b]


def _different(padded: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The different n-grams, sorted."""
    found = np.zeros(0, np.uint64)
    for _, k, inside in _grams(padded, bounds):
        found = np.union1d(found, k[inside])
    return found


def _only(batches: Iterator[pa.RecordBatch], ids) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if ids is not None:
            known = np.isin(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), ids.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(known))
        if batch.num_rows:
            yield batch


def _count(batches: Iterator[pa.RecordBatch], ids) -> Iterator[pa.RecordBatch]:
    for part, raw, at in chunks(_only(batches, ids), "text", _COUNT_BYTES):
        fold = part.column(part.schema.get_field_index("fold")).to_numpy()
        padded, bounds = _padded(raw, at)
        of = np.repeat(fold.astype(np.int8), np.diff(at) + ORDER)
        pieces = [(k[inside], of[a : a + len(k)][inside]) for a, k, inside in _grams(padded, bounds)]
        for f in range(FOLDS):
            key, n = np.unique(np.concatenate([k[o == f] for k, o in pieces]) if pieces else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), f, np.int32)), pa.array(key.view(np.int64)), pa.array(n)], names=["fold", "k", "c"])


def _mask(n: int) -> int:
    return (1 << (8 * n)) - 1


def _fold() -> F.Column:
    return F.pmod(F.xxhash64(F.lit("fold"), F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int")


def train(trusted: DataFrame, ids=None) -> DataFrame:
    """The models as (fold, kind, k, v): kind n is an n-gram's log-probability, kind -n the log-weight that a context of n - 1 bytes gives to lower orders.

    ``ids``: a broadcast array of the doc_ids that count; None: all do.
    """
    texts = trusted.filter("text is not null").select("doc_id", "text", _fold().alias("fold"))
    grams = {ORDER: cut(texts.mapInArrow(lambda it: _count(it, ids), "fold int, k long, c long").groupBy("fold", "k").agg(F.sum("c").alias("c")))}
    for n in range(ORDER - 1, 0, -1):
        grams[n] = cut(grams[n + 1].groupBy("fold", F.col("k").bitwiseAND(_mask(n)).alias("k")).agg(F.count("*").alias("c")))
    lower, parts = None, []
    for n in range(1, ORDER + 1):
        c = F.col("c")
        discount = F.lit(0.5)
        for row in grams[n].groupBy("fold").agg(*[F.count_if(c == i) for i in range(1, 5)]).collect():
            fold, *m = row[0], 0, *row[1:]
            y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0.0
            d = [max(0.0, min(float(i), i - (i + 1) * y * m[i + 1] / m[i])) if m[i] else 0.5 for i in (1, 2, 3)]
            discount = F.when(F.col("fold") == fold, F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])).otherwise(discount)
        context = F.shiftright("k", 8)
        contexts = grams[n].groupBy("fold", context.alias("ctx")).agg(F.sum("c").alias("total"), F.sum(discount).alias("given"))
        contexts = contexts.withColumn("weight", F.col("given") / F.col("total"))
        own = grams[n].withColumn("ctx", context).join(contexts, ["fold", "ctx"])
        if n == 1:
            p = own.select("fold", "k", ((c - discount) / F.col("total") + F.col("weight") / 256).alias("p"))
        else:
            below = lower.select("fold", F.col("k").alias("low"), F.col("p").alias("p_low"))
            p = own.withColumn("low", F.col("k").bitwiseAND(_mask(n - 1))).join(below, ["fold", "low"]).select("fold", "k", ((c - discount) / F.col("total") + F.col("weight") * F.col("p_low")).alias("p"))
        lower = cut(p)
        parts += [lower.select("fold", F.lit(n).alias("kind"), "k", F.log("p").alias("v")), contexts.select("fold", F.lit(-n).alias("kind"), F.col("ctx").alias("k"), F.log("weight").alias("v"))]
    model = parts[0]
    for x in parts[1:]:
        model = model.unionByName(x)
    return cut(model.filter("v is not null"))


class Shard:
    """Entries of one or more models, by fold and kind, sorted."""

    def __init__(self, fold: np.ndarray, kind: np.ndarray, k: np.ndarray, v: np.ndarray) -> None:
        self.tables = {}
        order = np.lexsort((k, kind, fold))
        fold, kind, k, v = fold[order], kind[order], k[order], v[order]
        first = np.flatnonzero(np.concatenate([[True], (fold[1:] != fold[:-1]) | (kind[1:] != kind[:-1])])) if len(k) else []
        for a, b in zip(first, [*first[1:], len(k)]):
            self.tables[int(fold[a]), int(kind[a])] = k[a:b], v[a:b]

    def get(self, fold: int, kind: int, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 if absent) and which are there."""
        k, v = self.tables.get((fold, kind), (np.zeros(0, np.uint64), np.zeros(0)))
        if not len(k):
            return np.zeros(len(key)), np.zeros(len(key), bool)
        at = np.minimum(np.searchsorted(k, key), len(k) - 1)
        there = k[at] == key
        return np.where(there, v[at], 0.0), there


def log_p(fold: int, k: np.ndarray, high: Shard, low: Shard) -> np.ndarray:
    """Log-probabilities, by the model ``fold``, of the last byte of each ORDER-gram; ``low`` has the kinds up to 2, ``high`` the others."""
    out, todo = np.zeros(len(k)), np.arange(len(k))
    for n in range(ORDER, 0, -1):
        gram, of = k[todo] & np.uint64(_mask(n)), high if n > 2 else low
        v, there = of.get(fold, n, gram)
        out[todo[there]] += v[there]
        todo = todo[~there]
        out[todo] += of.get(fold, -n, gram[~there] >> np.uint64(8))[0]
    out[todo] -= np.log(256)
    return out


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows for chunks of texts of one fold; a text longer than ``size`` is a chunk of its own."""
    coder = zstandard.ZstdCompressor(level=3)
    held: dict[int, list] = {f: [] for f in range(FOLDS)}
    room = dict.fromkeys(held, size)

    def chunk(f: int) -> pa.RecordBatch:
        columns = [pa.concat_arrays([p.column(i) for p in held[f]]) for i in range(3)]
        lengths = pa.array([len(x) for x in (columns[1].cast(pa.large_binary()).fill_null(b"")).to_pylist()], pa.int64())
        text = b"".join(columns[1].cast(pa.large_binary()).fill_null(b"").to_pylist())
        whole = [pa.array([x.to_pylist()], pa.list_(x.type)) for x in (columns[0], columns[2], lengths)]
        held[f], room[f] = [], size
        return pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), *whole, pa.array([coder.compress(text)], pa.binary())], names=["fold", "ids", "langs", "lengths", "text"])

    for part, _, at in chunks(batches, "text"):
        folds = part.column(3).to_numpy()
        for f in range(FOLDS):
            mine = np.flatnonzero(folds == f)
            if not len(mine):
                continue
            n = int(np.diff(at)[mine].sum())
            if n > room[f] and held[f]:
                yield chunk(f)
            held[f].append(part.take(pa.array(mine)))
            room[f] -= n
    for f in range(FOLDS):
        if held[f]:
            yield chunk(f)


def _unpacked(lengths: list[int], text: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(text), np.uint8) if sum(lengths) else np.zeros(0, np.uint8)
    return _padded(raw, np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64))


def _shard(k: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each n-gram, by the two bytes before its last; shard_of() is the same for the model's entries."""
    return (((k >> np.uint64(8)) & np.uint64(0xFFFF)).astype(np.int64) * 40503 % 65521) % n_shards


def shard_of(n_shards: int) -> F.Column:
    pair = F.when(F.col("kind") > 0, F.shiftright("k", 8)).otherwise(F.col("k")).bitwiseAND(0xFFFF)
    return (pair * 40503 % 65521) % n_shards


def _ask(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and shard, the different n-grams, sorted."""
    for batch in batches:
        for chunk, fold, lengths, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
            k = _different(*_unpacked(lengths, text))
            where = _shard(k, n_shards)
            order = np.argsort(where, kind="stable")
            k, where = k[order], where[order]
            first = np.flatnonzero(np.concatenate([[True], where[1:] != where[:-1]]))
            last = np.append(first[1:], len(k))
            content = pa.array([k[a:b].tobytes() for a, b in zip(first, last)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(where[first]), pa.array(np.full(len(first), chunk)), pa.array(np.full(len(first), fold, np.int32)), content], names=["shard", "chunk", "fold", "grams"])


def _answer(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Log-probabilities for the questions; each shard's entries come before its questions."""
    low, at, held, high = Shard(*shared.value), None, [], None
    for batch in batches:
        shards = batch.column(0).to_numpy()
        asks = batch.column(1).to_numpy() == 1
        edges = np.flatnonzero(np.concatenate([[True], (shards[1:] != shards[:-1]) | (asks[1:] != asks[:-1])])) if len(shards) else []
        for a, b in zip(edges, [*edges[1:], len(shards)]):
            if shards[a] != at:
                at, held, high = shards[a], [], None
            if not asks[a]:
                held.append([batch.column(i).slice(a, b - a).to_numpy() for i in (2, 3, 4, 5)])
                continue
            if high is None:
                columns = [np.concatenate(x) for x in zip(*held)] if held else [np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0)]
                high, held = Shard(columns[0], columns[1], columns[2].view(np.uint64), columns[3]), []
            for i in range(a, b):
                fold, k = batch.column(2)[i].as_py(), np.frombuffer(batch.column(7)[i].as_py(), np.uint64)
                # a text of one fold is scored by the model of the other
                p = log_p((fold + 1) % FOLDS, k, high, low).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([batch.column(6)[i].as_py()], pa.int64()), pa.array([int(at)], pa.int64()), pa.array([p.tobytes()], pa.binary())], names=["chunk", "shard", "answers"])


def _score(batches: Iterator[pa.RecordBatch], n_shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, langs, lengths, text, answers = (batch.column(j)[i] for j in range(5))
            padded, bounds = _unpacked(lengths.as_py(), text.as_py())
            k = _different(padded, bounds)
            where, p = _shard(k, n_shards), np.zeros(len(k), np.float32)
            order = np.argsort(where, kind="stable")
            first = np.searchsorted(where[order], np.arange(n_shards + 1))
            for x in answers.as_py():
                p[order[first[x["shard"]] : first[x["shard"] + 1]]] = np.frombuffer(x["answers"], np.float32)
            total = np.zeros(len(ids))
            for a, gram, inside in _grams(padded, bounds):
                of = np.searchsorted(bounds[0], np.arange(a, a + len(gram))[inside], "right") - 1
                total += np.bincount(of, p[np.searchsorted(k, gram[inside])], len(ids))
            yield pa.RecordBatch.from_arrays([ids.values, langs.values, lengths.values, pa.array(total)], names=["doc_id", "lang", "n_bytes", "log_p"])


def scores(docs: DataFrame, model: DataFrame, chunk: int = CHUNK, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """(doc_id, lang, n_bytes, log_p, perplexity) for each row of ``docs``; the perplexity is per byte, the end of the text included."""
    spark = docs.sparkSession
    n_parts = partitions(spark)
    n_shards = max(n_parts, -(-model.count() // shard_entries))
    low = model.filter(F.col("kind").between(-2, 2)).toArrow()  # at most 256 * 256 + 2 * 256 + 1 a fold
    shared = spark.sparkContext.broadcast((low["fold"].to_numpy(), low["kind"].to_numpy(), low["k"].to_numpy().view(np.uint64), low["v"].to_numpy()))

    packed = docs.select("doc_id", "text", "lang", _fold().alias("fold")).mapInArrow(lambda it: _pack(it, chunk), "fold int, ids array<long>, langs array<string>, lengths array<long>, text binary")
    at = fresh_path(spark, "kn_chunks")
    name = "fundalake_" + at.rsplit("-", 1)[1]
    packed.withColumn("chunk", F.monotonically_increasing_id()).write.option("path", at).bucketBy(n_parts, "chunk").saveAsTable(name)
    table = spark.table(name)

    none = lambda kind: F.lit(None).cast(kind)
    entries = model.filter(~F.col("kind").between(-2, 2)).select(shard_of(n_shards).alias("shard"), F.lit(0).alias("asks"), "fold", "kind", "k", "v", none("long").alias("chunk"), none("binary").alias("grams"))
    asked = table.select("chunk", "fold", "lengths", "text").mapInArrow(lambda it: _ask(it, n_shards), "shard long, chunk long, fold int, grams binary")
    asked = asked.select("shard", F.lit(1).alias("asks"), "fold", none("int").alias("kind"), none("long").alias("k"), none("double").alias("v"), "chunk", "grams")
    met = entries.unionByName(asked).repartition(n_parts, "shard").sortWithinPartitions("shard", "asks")
    answers = met.mapInArrow(lambda it: _answer(it, shared), "chunk long, shard long, answers binary")
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "answers")).alias("answers"))
    joined = table.join(answers.hint("merge"), "chunk").select("ids", "langs", "lengths", "text", "answers")
    out = cut(joined.mapInArrow(lambda it: _score(it, n_shards), "doc_id long, lang string, n_bytes long, log_p double"))
    spark.sql(f"DROP TABLE {name}")
    return out.withColumn("perplexity", F.exp(-F.col("log_p") / (F.col("n_bytes") + 1)))


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that a label calls good."""
    good = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct()
    return docs.join(good, docs.doc_id == good["_good"], "left_semi")


def classify(docs: DataFrame, labels: DataFrame, quantiles: tuple[float, float] = QUANTILES) -> DataFrame:
    """(doc_id, lang, n_bytes, log_p, perplexity, low, high, kept) for each row of ``docs``.

    kept: the perplexity is between the quantiles of the trusted texts of its
    language and length.  A null text counts as empty; a very long text is a
    chunk of its own; null languages are a group of their own; a null doc_id is
    never trusted; repeated rows are scored alike; other columns are ignored;
    an empty table gives an empty result.  Without any trusted text each byte
    has probability 1/256, there are no thresholds, and everything is kept.
    """
    good = cut(labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("_good")).distinct())
    if good.count() <= TRUSTED_ROWS:
        model = train(docs.select("doc_id", "text"), docs.sparkSession.sparkContext.broadcast(np.sort(good.toArrow()["_good"].to_numpy())))
    else:
        model = train(trusted_rows(docs.select("doc_id", "text"), labels))
    octave = F.floor(F.log2(F.col("n_bytes") + 1)).cast("int")
    out = scores(docs.select("doc_id", "text", "lang"), model).withColumn("octave", octave)
    trusted = out.join(good, out.doc_id == good["_good"], "left_semi")
    for level, keys in enumerate((["lang", "octave"], ["lang"], [])):
        limits = trusted.groupBy(*keys).agg(F.count("*").alias("n"), F.percentile_approx("perplexity", list(quantiles), 10000).alias(f"limits{level}"))
        if keys:  # a row for each language and power of 2
            limits = limits.filter(F.col("n") >= MIN_TRUSTED).select(*[F.col(k).alias(f"{k}{level}") for k in keys], f"limits{level}")
            out = out.join(limits, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}{level}")) for k in keys]), "left")
        else:
            out = out.join(F.broadcast(limits.select(f"limits{level}")), F.lit(True), "left")  # one row
    limits = F.coalesce("limits0", "limits1", "limits2")
    low, high = limits[0], limits[1]
    return out.select("doc_id", "lang", "n_bytes", "log_p", "perplexity", low.alias("low"), high.alias("high"), F.coalesce(F.col("perplexity").between(low, high), F.lit(True)).alias("kept"))
