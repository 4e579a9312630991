"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundalake.llm import chat, decontam, html_extract, kn_model, langid, mixing, periodic, quality_rules, secret_scan, simhash, substring_dedup, warc, whitening
from fundalake.llm.common import cut, fresh_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).drop("payload")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = langid.held_out(F.col("doc_id"))
    found = cut(langid.predict(docs, langid.train(docs.filter(~held))))
    return langid.judged(found, langid.medians(found, ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.read_back(*chat.build(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_table(spark, sf_dir, "documents"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kn_model.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.without_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.audit(_table(spark, sf_dir, "documents").select("doc_id", "text"), fresh_path(spark, "ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin(*[r.kind for r in secret_scan.BASE]))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", *[number(r.kind) for r in secret_scan.BASE], F.sha2(secret_scan.told(base), 256).alias("base_sha256"), secret_scan.told(F.col("spans")).alias("spans"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = periodic.collapsed(periodic.with_tails(_table(spark, sf_dir, "documents")))
    out = out.select("doc_id", "runs", "kept_text", periodic.best(F.col("runs")).alias("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    exponent = F.floor(F.lit(1000).cast("decimal(10,0)") * F.col("best.length") / F.col("best.period")).cast("long")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent.alias("exponent_milli"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("kept_text", 256).alias("collapsed_sha256"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.components(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_html_extraction, op2_warc, op3_language_id, op4_chat_format, op5_simhash, op6_decontamination, op7_quality_rules, op8_quality_model, op9_substring_dedup, op10_mixing, op11_secret_scan, op12_periodic_runs, op13_whitening)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT page_id, octet_length(encode(t)) AS n, sha1(t) AS s FROM p),
g AS (SELECT s, max(page_id) AS top FROM h WHERE n >= 1000 GROUP BY s)
SELECT h.page_id, CAST(h.n AS BIGINT) AS payload_bytes, h.s AS payload_digest,
       CASE WHEN h.page_id IS DISTINCT FROM g.top AND g.top IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN h.page_id IS DISTINCT FROM g.top THEN g.top END AS refers_to
FROM h LEFT JOIN g ON h.s = g.s AND h.n >= 1000
"""

_ESCAPED = r"replace(replace(replace(replace(replace(replace(replace({}, '\', '\\'), '<s>', '\0'), '</s>', '\1'), '[INST]', '\2'), '[/INST]', '\3'), '<role>', '\4'), '</role>', '\5')"
_OP4 = f"""
WITH c AS (
  SELECT coalesce('id ' || conv_id, 'row ' || row_number() OVER ()) AS conv, conv_id, coalesce(turn, 0) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT 'id -7', -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT 'id -7', -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS said,
             length('<s><role></role></s>') + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")})
             + CASE WHEN role = 'assistant' THEN 0 ELSE length('[INST][/INST]') END AS n FROM c)
SELECT CAST(any_value(conv_id) AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(length(string_agg(said, '' ORDER BY turn, role, text)) AS BIGINT) AS loss_chars,
       sha256(string_agg(said, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv
"""

_FLOOR = "CASE WHEN b < 64 THEN b ELSE (b - ((b - 32) // 32) * 32) << CAST((b - 32) // 32 AS INT) END"


def _fences(keys: str) -> str:
    by = f"{keys}, " if keys else ""
    names = (*quality_rules.MEASURES, "length")
    spread = {m: f"greatest({m}_q3 - {m}_q1, {m}_q3 // 8 + 1, {'1000 // length_q1' if m in quality_rules.RATES else '0'})" for m in quality_rules.MEASURES}
    return f"""
  SELECT {by}total, {", ".join(f"{m}_q1 - 3 * {x} AS {m}_low, {m}_q3 + 3 * {x} AS {m}_high" for m, x in spread.items())}
  FROM (SELECT {by}max(total) AS total, {", ".join(f"max(CASE WHEN m = '{m}' THEN {c} END) AS {m}_{c}" for m in names for c in ("q1", "q3"))}
    FROM (SELECT {by}m, max(total) AS total, min(CASE WHEN run * 4 >= total THEN v END) AS q1, min(CASE WHEN run * 4 >= total * 3 THEN v END) AS q3
      FROM (SELECT {by}m, {_FLOOR} AS v, sum(n) OVER (PARTITION BY {by}m ORDER BY b) AS run, sum(n) OVER (PARTITION BY {by}m) AS total
            FROM (SELECT {by}m, b, sum(n) AS n FROM sketch GROUP BY {by}m, b))
      GROUP BY {by}m) {f"GROUP BY {keys}" if keys else ""})"""


_OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
five AS (SELECT r, i, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT r, i FROM five JOIN (SELECT r AS r2, s AS s2 FROM five GROUP BY r, s HAVING count(*) > 1) ON r = r2 AND s = s2),
rep AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS j FROM hit) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT d.r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN lines ON d.r = lines.r),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, 1000 * n_symbols // nullif(n_words, 0) AS symbols,
                  1000 * n_dup_lines // nullif(n_words, 0) AS dup_lines, 100 * word_chars // nullif(n_words, 0) AS word_len FROM base),
long AS (SELECT lang, source, 'symbols' AS m, symbols AS x FROM judged WHERE NOT base_failed UNION ALL
         SELECT lang, source, 'dup_lines', dup_lines FROM judged WHERE NOT base_failed UNION ALL
         SELECT lang, source, 'word_len', word_len FROM judged WHERE NOT base_failed UNION ALL
         SELECT lang, source, 'length', n_words FROM judged WHERE NOT base_failed),
sketch AS (SELECT lang, source, m, b, count(*) AS n FROM (
  SELECT lang, source, m, shift * 32 + (x >> shift) AS b FROM (SELECT *, CAST(greatest(length(bin(x)) - 6, 0) AS INT) AS shift FROM long)) GROUP BY ALL),
own AS ({_fences("lang, source")}), tongue AS ({_fences("lang")}), everything AS ({_fences("")})
SELECT j.doc_id, j.n_words, j.word_chars, j.n_symbols, j.n_dup_lines, j.n_repeat_words, j.base_failed,
       CASE WHEN j.base_failed THEN false ELSE
         j.symbols <= coalesce(o.symbols_high, t.symbols_high, e.symbols_high)
         AND j.dup_lines <= coalesce(o.dup_lines_high, t.dup_lines_high, e.dup_lines_high)
         AND j.word_len BETWEEN coalesce(o.word_len_low, t.word_len_low, e.word_len_low) AND coalesce(o.word_len_high, t.word_len_high, e.word_len_high) END AS kept
FROM judged j
LEFT JOIN own o ON j.lang IS NOT DISTINCT FROM o.lang AND j.source IS NOT DISTINCT FROM o.source AND o.total >= 100
LEFT JOIN tongue t ON j.lang IS NOT DISTINCT FROM t.lang AND t.total >= 100
CROSS JOIN everything e
"""

_OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
k AS (SELECT r, i, md5(array_to_string(w[i:i+34], ' ')) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
hit AS (SELECT r, i FROM k WHERE s IN (SELECT s FROM k GROUP BY s HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS j FROM hit),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.r = kept.r
"""


def _take(i: int) -> str:
    """One size class of the part pass, in SQL."""
    later = " + ".join(f"t{j}" for j in range(i, 3))
    got = f"coalesce(sum(CASE WHEN more{i - 1} AND cls < {i} THEN size END) OVER (PARTITION BY source), 0)" if i else "0"
    before = f"more{i - 1} OR " if i else ""
    return f"""
p{i} AS (SELECT *, {before}(cls = {i} AND size > 0 AND 2 * own + size <= 2 * CASE WHEN {later} > 0 THEN (rest - got{i}) * t{i} / ({later}) ELSE 0.0 END) AS more{i}
  FROM (SELECT *, CAST({got} AS BIGINT) AS got{i} FROM {f"p{i - 1}" if i else "o"}))"""


def _at(x: str) -> str:
    """When the schedule that runs straight from w0 to w1 has given x."""
    return f"CASE WHEN target > 0 THEN least(2 * {x} / (w0 + sqrt(greatest(w0 * w0 + 2 * (w1 - w0) * {x}, CAST(0 AS DOUBLE)))), CAST(1 AS DOUBLE)) ELSE CAST(0 AS DOUBLE) END"


_OP10 = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM d GROUP BY source),
w AS (SELECT *, CAST((rn - 1) % 3 + 1 AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS most FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(most) OVER (ORDER BY most / weight, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / sum(weight) OVER (ORDER BY most / weight, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, weight, least(most, max(level) OVER () * weight) AS target FROM l),
u AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS passes FROM t),
v AS (SELECT *, target - passes * source_size AS rest FROM u),
c AS (SELECT d.doc_id, d.source, d.size, d.k, v.source_size, v.target, v.passes, v.rest, v.weight,
             CASE WHEN size * 16 > rest THEN 0 WHEN size * 128 > rest THEN 1 ELSE 2 END AS cls
      FROM d JOIN v ON d.source IS NOT DISTINCT FROM v.source),
o AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source, cls ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS own,
             CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS start,
             weight * (1 - (weight - 2) / 4) AS w0, weight * (1 + (weight - 2) / 4) AS w1,
             {", ".join(f"CAST(coalesce(sum(CASE WHEN cls = {i} THEN size END) OVER (PARTITION BY source), 0) AS BIGINT) AS t{i}" for i in range(3))} FROM c),
{",".join(_take(i) for i in range(3))},
q AS (SELECT *, passes + CAST(more2 AS BIGINT) AS copies FROM p2),
m AS (SELECT *, least(start, target) / target * weight AS x0, least(CAST(copies - 1 AS DOUBLE) * source_size + start, target) / target * weight AS x1 FROM q)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies,
       CASE WHEN copies > 0 THEN {_at("x0")} END AS first_position, CASE WHEN copies > 0 THEN {_at("x1")} END AS last_position FROM m
"""


def _spans(i: int, kind: str, pattern: str, group: int, least: int) -> str:
    """The spans of a rule in SQL: what lies between its matches says where they are."""
    pattern = pattern.replace("'", "''")
    return f"""
  SELECT r, {i} AS kind_no, '{kind}' AS kind, start, start + length(m) AS stop FROM (
    SELECT r, s[j] AS m, CAST(list_sum(list_transform(between[:j], lambda x: length(x))) + coalesce(list_sum(list_transform(s[:j-1], lambda x: length(x))), 0) AS BIGINT) AS start
    FROM (SELECT r, s, between, unnest(range(1, len(s) + 1)) AS j
          FROM (SELECT r, regexp_extract_all(t, '{pattern}') AS s, string_split_regex(t, '{pattern}') AS between FROM d)))
  WHERE length(regexp_extract(m, '{pattern}', {group})) >= {least}"""


_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_spans(i, *rule[:4]) for i, rule in enumerate(secret_scan.RULES))}),
told AS (SELECT r, {", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in secret_scan.BASE)},
                string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no, stop) FILTER (kind_no < {len(secret_scan.BASE)}) AS base,
                string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no, stop) AS spans FROM s GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in secret_scan.BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN told ON d.r = told.r
"""

SQL = {"op2_warc": _OP2, "op4_chat_format": _OP4, "op7_quality_rules": _OP7, "op9_substring_dedup": _OP9, "op10_mixing": _OP10, "op11_secret_scan": _OP11}
