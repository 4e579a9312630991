"""Language identification by compression.

Each language gets a zstandard raw-content dictionary made of training
snippets.  A text, in lower case, is cut into pieces of ``piece`` bytes, each piece is encoded
with every dictionary, and the language whose pieces are smallest in sum wins.
Pieces keep a long text from becoming its own dictionary, which would drown the
difference; all pieces of the whole text count.

A text is rejected if its margins are narrow: the runner-up needs hardly more
than the best, or the best dictionary saves hardly anything against none (a
language that was not learned, or noise).  What is narrow is set by the learned
rows themselves: ``NARROW`` of the median margin of their language, from a
mergeable quantile sketch over all of them.

The dictionaries are the only thing that is fitted: ``dict_bytes`` of snippets
for each language at most, taken from training rows by a hash of their doc_id
(the documented bound of the sample; the number of training rows itself is
counted over all rows).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from fundalake.llm.common import cut

DICT_BYTES = 1 << 18
SNIPPET = 256
PIECE = 768
LEVEL = 5
#: The share of a language's median margins below which a text is rejected.
NARROW = 0.05
UNKNOWN = "und"
MAX_LANGUAGES = 512


def held_out(doc_id) -> F.Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, dict_bytes: int = DICT_BYTES) -> dict[str, bytes]:
    """{language: dictionary} from rows (doc_id, text, lang); null languages and texts without a letter are left out.

    Two scans, whatever the number of languages: one counts the rows of each,
    one takes the snippets of all.  More than MAX_LANGUAGES raise an error.
    """
    rows = labelled.filter(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return {}
    want = 2 * dict_bytes // SNIPPET
    order = F.xxhash64(F.lit("langid"), F.col("doc_id"))
    # about 3 * want rows of a language pass the hash; of these the first ``want`` snippets are kept, so little is sorted
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, 3 * want / n) * (1 << 20)))])
    some = rows.filter(F.pmod(order, F.lit(1 << 20)) <= share[F.col("lang")]).filter(F.col("text").isNotNull())
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - SNIPPET, F.lit(1))).cast("int") + 1
    snippets = some.select("lang", F.lower(F.substring("text", at, F.lit(SNIPPET))).alias("s"), order.alias("o")).filter(F.col("s").rlike(r"\p{L}")).groupBy("lang", "s").agg(F.min("o").alias("o"))
    first = snippets.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy("o", "s"))).filter(F.col("rank") <= want)
    found: dict[str, list] = {}
    for r in sorted(first.collect(), key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["s"])
    return {lang: "\n".join(s).encode()[-dict_bytes:] for lang, s in found.items()}  # copies of a text count once


def _coders(dictionaries: dict[str, bytes]) -> tuple[list[str], list[zstandard.ZstdCompressor]]:
    """The languages and their coders; at the end, one without a dictionary."""
    langs = sorted(dictionaries)
    made = []
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
    for lang in langs:
        d = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(dict_data=d, compression_params=params))
    return langs, [*made, zstandard.ZstdCompressor(compression_params=params)]


def sizes(text: bytes, coders: list[zstandard.ZstdCompressor]) -> list[int]:
    pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
    return [sum(len(c.compress(p)) for p in pieces) for c in coders]


def decide(langs: list[str], size: list[int], plain: int) -> tuple[str, float, float, float]:
    """Language, score, how much more of its size the runner-up needs, and the share that the best saves of the size without a dictionary.

    The score is a probability for the best: each byte that another needs more
    halves its weight.  Ties go to the first language by name.  A language
    without a rival has a gap of 1.
    """
    best = min(range(len(langs)), key=lambda i: (size[i], i))
    score = 1 / math.fsum(2.0 ** -min(60, s - size[best]) for s in size)
    gap = min((s - size[best] for i, s in enumerate(size) if i != best), default=size[best])
    return langs[best], score, gap / size[best], 1 - size[best] / plain


def _predict(batches: Iterator[pa.RecordBatch], dictionaries: dict[str, bytes]) -> Iterator[pa.RecordBatch]:
    langs, coders = _coders(dictionaries)
    for batch in batches:
        out = []
        for text, has in zip(batch.column(1), batch.column(2)):
            if not has.as_py() or not langs:
                out.append((UNKNOWN, 0.0, None, None))
            else:
                *size, plain = sizes(text.as_py().lower().encode(), coders)
                out.append(decide(langs, size, plain))
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], *batch.columns[3:]], names=["doc_id", "lang_pred", "score", "gap", "gain", *batch.schema.names[3:]])


def predict(docs: DataFrame, dictionaries: dict[str, bytes], whole: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, gap, gain), and with ``whole`` the row itself as doc, a row per row of ``docs``.

    A null or empty text, one without a letter, or any text if nothing could be
    learned: ``und`` with score 0 and null margins.  Only the text is looked at,
    all of it however long; a null doc_id is carried along; repeated rows get
    equal results; an empty table gives an empty result.
    """
    has = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    doc = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []
    rows = docs.select("doc_id", "text", has.alias("has"), *doc)
    kind = StructType([rows.schema["doc_id"], StructField("lang_pred", StringType()), *[StructField(c, DoubleType()) for c in ("score", "gap", "gain")], *([rows.schema["doc"]] if whole else [])])
    return rows.mapInArrow(lambda it: _predict(it, dictionaries), kind)


def medians(found: DataFrame, learned: F.Column) -> DataFrame:
    """(_lang, _gap, _gain): the median margins of the rows of a written result of predict() that are ``learned``; a row per language, at most MAX_LANGUAGES."""
    return cut(found.filter(learned & (F.col("lang_pred") != UNKNOWN)).groupBy(F.col("lang_pred").alias("_lang")).agg(*[F.percentile_approx(c, 0.5, 1000).alias(f"_{c}") for c in ("gap", "gain")]))


def judged(found: DataFrame, median: DataFrame, narrow: float = NARROW) -> DataFrame:
    """``found``, a result of predict(), with rejected: ``und``, or a margin below ``narrow`` of the median of its language.

    In a language of which no learned row is predicted, only texts without a
    gap or a gain are rejected.
    """
    out = found.join(F.broadcast(median), found.lang_pred == F.col("_lang"), "left")
    zero = F.lit(0.0)
    wide = (F.col("gap") > narrow * F.coalesce("_gap", zero)) & (F.col("gain") > narrow * F.greatest(F.coalesce("_gain", zero), zero))
    return out.withColumn("rejected", ~F.coalesce(wide, F.lit(False))).drop("_lang", "_gap", "_gain")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is recognised, by dictionaries learned from those rows that have one.

    Null and empty texts and those without a letter go, as do texts whose
    margins are narrow; other rows stay as they are, repeated ones too, with
    columns of any name; an empty table gives an empty result.  Texts are
    encoded twice, for the medians and for the verdict, and never stored.
    """
    learned = ~held_out(F.col("doc_id"))
    dictionaries = train(docs.filter(learned))
    median = medians(cut(predict(docs, dictionaries)), learned)
    return judged(predict(docs, dictionaries, whole=True), median).filter(~F.col("rejected")).select("doc.*")
