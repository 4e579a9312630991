"""Secrets in every version of every text, with a ledger of what has been scanned.

Addresses.  A text's blob is the SHA-256 of its UTF-8 bytes, so equal texts
under any number of paths and versions are one blob; a null text is the empty
blob.  A rule's version is a hash of its definition, so a changed rule is a new
one and an unchanged rule keeps its version.

Ledger.  A Parquet folder with a row for each scan of a blob: the blob, the
versions of the rules that were tried, and the spans found.  ``scan`` looks up
which (blob, rule version) pairs are not in it, reads only the texts that stand
for those blobs (of the rows with one text, those of the least path), tries only
the missing rules on each, and appends.  A scan that dies leaves nothing
behind, as Spark commits the appended files together; a scan that is repeated
finds nothing to do.  Two that run at once may record a pair twice, with the
same spans; ``findings`` counts them once.

Plan.  Texts are joined with the pending blobs by (blob, path): up to
``FEW`` of those are sent to all executors, as after a day's changes; beyond
that, as at first, the texts are shuffled once, by a key that differs between
the copies of a common text.  Spans go back
to all paths by a left join on the blob; only blobs with findings take part in it.

Rules never look at a character twice without matching it, so the time is in
proportion to the text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import chunks, cut, small


class Rule(NamedTuple):
    """Leftmost matches of ``pattern`` that do not overlap; those whose ``group`` has under ``least`` characters are dropped, after they have taken their place.

    The pattern is over ASCII and runs on UTF-8 bytes; ``needle``: bytes that every match holds, if any.
    """

    kind: str
    pattern: str
    group: int
    least: int
    needle: str = ""

    def version(self) -> int:
        told = "\0".join((self.kind, self.pattern, str(self.group), str(self.least)))
        return int.from_bytes(hashlib.sha256(told.encode()).digest()[:8], "big", signed=True)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
#: The contract's three kinds.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, "AKIA"),
    Rule("hex", "[0-9a-f]{16,}", 0, 16),
)
#: Further public token formats: private key blocks, code host and chat tokens, JSON web tokens, passwords in addresses.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*(-----END [A-Z ]*PRIVATE KEY-----)?", 0, 27, "-----BEGIN "),
    Rule("host", "gh[pousr]_[A-Za-z0-9]+", 0, 34, "gh"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 0, 20, "xox"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]*(\.[A-Za-z0-9_-]*)?(\.[A-Za-z0-9_-]*)?", 2, 9, "eyJ"),
    Rule("url", r"://[^\x00-\x20/:@]+:([^\x00-\x20/:@]+)@", 1, 4, "://"),
)
RULES = BASE + MORE
#: Most pending blobs that are sent to all executors.
FEW = 1 << 14
_SPAN = "struct<rule:long,kind:string,start:long,end:long>"


def spans_of(text: bytes, rules: Sequence[tuple[Rule, int, re.Pattern]]) -> list[tuple[int, str, int, int]]:
    """(rule version, kind, start, end) of the matches in a text; bounds in code points."""
    found = []
    for rule, version, pattern in rules:
        if rule.needle and rule.needle.encode() not in text:
            continue
        for m in pattern.finditer(text):
            if m.group(rule.group) and len(m.group(rule.group).decode(errors="ignore")) >= rule.least:
                found.append((version, rule.kind, m.start(), m.end()))
    if found and not text.isascii():
        raw = np.frombuffer(text, np.uint8)
        before = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        found = [(v, k, int(before[a]), int(before[b])) for v, k, a, b in found]
    return found


def _scan(batches: Iterator[pa.RecordBatch], rules: Sequence[Rule]) -> Iterator[pa.RecordBatch]:
    ready = {r.version(): (r, r.version(), re.compile(r.pattern.encode())) for r in rules}
    kind = pa.list_(pa.struct([("rule", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for part, raw, at in chunks(batches, "text"):
        data, cuts = raw.tobytes(), at.tolist()
        missing = part.column(part.schema.get_field_index("missing"))
        found = [[dict(zip(("rule", "kind", "start", "end"), s)) for s in spans_of(data[cuts[i] : cuts[i + 1]], [ready[v] for v in versions])] for i, versions in enumerate(missing.to_pylist())]
        yield pa.RecordBatch.from_arrays([part.column(0), missing, pa.array(found, kind)], names=["blob", "rules", "found"])


def blob(text: str = "text") -> Column:
    """The address of a text."""
    return F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256))


def _ledger(df: DataFrame, at: str) -> DataFrame | None:
    """The ledger in folder ``at``, if there is one yet."""
    spark = df.sparkSession
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/_SUCCESS")
    there = p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
    return spark.read.schema(f"blob binary, rules array<long>, found array<{_SPAN}>").parquet(at) if there else None


def pending(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id") -> DataFrame:
    """(blob, path, missing): the blobs that lack a rule in the ledger, the least path that has them, and the versions of those rules."""
    blobs = versions.select(blob().alias("blob"), F.col(f"`{path}`").alias("path")).groupBy("blob").agg(F.min("path").alias("path"))
    wanted = F.array(*[F.lit(r.version()).cast("long") for r in rules])
    done = _ledger(versions, ledger)
    if done is None:
        return blobs.withColumn("missing", wanted)
    tried = done.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("tried"))
    missing = F.when(F.col("tried").isNull(), wanted).otherwise(F.array_except(wanted, "tried"))
    return blobs.join(tried, "blob", "left").select("blob", "path", missing.alias("missing")).filter(F.size("missing") > 0)


def scan(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id") -> None:
    """Append what the ledger lacks for the texts of ``versions``."""
    todo = small(cut(pending(versions, ledger, rules, path)), FEW)
    texts = versions.select(blob().alias("b"), F.col(f"`{path}`").alias("p"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(todo, (F.col("b") == F.col("blob")) & F.col("p").eqNullSafe(F.col("path"))).select("blob", "text", "missing")
    rows = texts.mapInArrow(lambda it: _scan(it, rules), f"blob binary, rules array<long>, found array<{_SPAN}>")
    # rows that are there twice, path and all, have been scanned each
    once = rows.groupBy("blob").agg(F.first("rules").alias("rules"), F.first("found").alias("found"))
    once.write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``versions`` with spans, array<struct<kind, start, end>>, by start, then kind in the order of the rules, then end; empty where the ledger has none."""
    done = _ledger(versions, ledger)
    if done is None:
        raise FileNotFoundError(ledger)
    current = F.array(*[F.lit(r.version()).cast("long") for r in rules])
    order = F.array(*[F.lit(r.kind) for r in rules])
    each = done.filter(F.size("found") > 0).select("blob", F.explode("found").alias("x")).filter(F.array_contains(current, F.col("x.rule")))
    rank = F.array_position(order, F.col("x.kind")).alias("rank")
    sorted_ = F.sort_array(F.collect_set(F.struct(F.col("x.start").alias("start"), rank, F.col("x.end").alias("end"), F.col("x.kind").alias("kind"))))
    spans = F.transform(sorted_, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    by_blob = small(cut(each.groupBy("blob").agg(spans.alias("spans"))))
    rows = versions.select(F.struct(*[F.col(f"`{c}`") for c in versions.columns]).alias("row"), blob().alias("b"))
    out = rows.join(by_blob, F.col("b") == F.col("blob"), "left")
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in versions.columns if c != "spans"], F.coalesce("spans", none).alias("spans"))


def audit(versions: DataFrame, ledger: str, rules: Sequence[Rule] = RULES, path: str = "doc_id") -> DataFrame:
    """``scan``, then ``findings``: the secrets of every row of ``versions``, of which only what is new since the last audit is read.

    Null texts are empty texts, without findings.  Very long texts are scanned
    whole.  Repeated rows, and equal texts under other paths, get equal spans; a
    null path is a path like any other.  An empty table gives an empty result.
    Extra columns come along, whatever their names (one named spans is replaced).
    """
    scan(versions, ledger, rules, path)
    return findings(versions, ledger, rules)


def told(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
