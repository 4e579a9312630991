"""Every name that the operators use inside or give to a result, as an extra column of their input."""

import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fundalake.llm import chat, decontam, html_extract, kn_model, langid, mixing, periodic, quality_rules, secret_scan, simhash, substring_dedup, warc, whitening
from fundalake.llm.common import fresh_path

SOURCES = "\n".join(p.read_text() for p in (Path(__file__).resolve().parents[2] / "fundalake/llm").glob("*.py"))
NAMES = sorted({n.lower() for n in re.findall(r'(?:alias|withColumn|col)\("(\w+)"', SOURCES)} | {n.lower() for group in re.findall(r'names=\[([^\]]*)\]', SOURCES) for n in re.findall(r'"(\w+)"', group)} | {n.lower() for kinds in re.findall(r'"((?:`?\w+`? \w[\w<>]*, )+`?\w+`? \w[\w<>]*)"', SOURCES) for n in re.findall(r"`?(\w+)`? \w", kinds)})


def clashing(df):
    """``df`` with a column for each of the names; a few are nested."""
    kinds = [lambda n: F.lit(n), lambda n: F.array(F.lit(n)), lambda n: F.struct(F.lit(n).alias("text")), lambda n: F.create_map(F.lit(n), F.lit(1)), lambda n: F.lit(None).cast("double")]
    have = {c.lower() for c in df.columns}
    return df.withColumns({n: kinds[i % len(kinds)](n) for i, n in enumerate(NAMES) if n not in have})


def rows_of(df, columns):
    return sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(41)
    prose = lambda n: " ".join(f"w{rng.randint(0, 300)}" for _ in range(n))
    shared = prose(60)
    rows = [(i, prose(50) + (f" {shared} {i}" if i % 5 == 0 else ""), "en", "s") for i in range(40)]
    rows += [(1, None, "en", "a"), (2, "", "en", None), (3, "one", "en", "a"), (3, "one", "en", "a"), (None, "one two", None, None), (60, "é " * 30_000 + "end", "fr", "b")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("n_chars", F.length("text").cast("long"))


@pytest.fixture(scope="module")
def items(spark, table):
    return spark.createDataFrame([(1, " ".join(table.filter("doc_id = 5").first().text.split()[10:30])), (None, "w1 w2 w3")], "item_id long, text string")


DOCUMENTS = {
    "language": (lambda d, b, l: langid.predict(d, langid.train(d)), ["doc_id", "lang_pred", "score"]),
    "simhash": (lambda d, b, l: simhash.near_duplicates(d), ["doc_id", "fp", "component_id"]),
    "decontamination": (lambda d, b, l: decontam.report(d, b), ["doc_id", "n_overlaps", "item_ids"]),
    "rules": (lambda d, b, l: quality_rules.verdicts(d), ["doc_id", "n_words", "kept"]),
    "model": (lambda d, b, l: kn_model.classify(d, l), ["doc_id", "n_bytes", "kept"]),
    "substrings": (lambda d, b, l: substring_dedup.without_repeats(d), ["doc_id", "kept_text", "n_words", "n_removed"]),
    "mixing": (lambda d, b, l: mixing.mix(d), ["doc_id", "size", "target", "taken"]),
    "secrets": (lambda d, b, l: secret_scan.audit(d, fresh_path(d.sparkSession, "ledger")), ["doc_id", "text", "spans"]),
    "periodic": (lambda d, b, l: periodic.collapsed(d), ["doc_id", "text", "runs", "kept_text"]),
}
STAGES = {
    "language": lambda d, b: langid.accepted(d),
    "simhash": lambda d, b: simhash.deduplicated(d),
    "substrings": lambda d, b: substring_dedup.applied(d),
    "decontamination": lambda d, b: decontam.clean(d, b),
    "mixing": lambda d, b: mixing.ordered(d),
}


@pytest.mark.parametrize("name", DOCUMENTS)
def test_operators(spark, table, items, name):
    run, columns = DOCUMENTS[name]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert rows_of(run(clashing(table), clashing(items), clashing(labels)), columns) == rows_of(run(table, items, labels), columns)


@pytest.mark.parametrize("name", STAGES)
def test_stages(table, items, name):
    run, wide = STAGES[name], clashing(table)
    got, want = run(wide, clashing(items)), run(table, items)
    columns = table.columns
    assert len(NAMES) > 120
    if name == "mixing":  # copy and position are its own
        assert set(got.columns) == set(wide.columns) | {"copy", "position"}
        assert rows_of(got.drop("copy", "position"), columns) == rows_of(want.drop("copy", "position"), columns)
    else:
        assert got.columns == wide.columns and rows_of(got, columns) == rows_of(want, columns)
        assert got.select("hits").distinct().collect() == wide.select("hits").distinct().collect()


def test_pages(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i % 3}", f"<html><body><nav>menu</nav><article><p>text {i}</p></article></body></html>" + " " * (1200 if i % 2 else 0)) for i in range(8)] + [(9, None, None), (None, "x", "<p>a")], "page_id long, url string, html string")
    for run, columns in ((html_extract.extract, ["page_id", "text", "n_chars"]), (warc.round_trip, ["page_id", "payload_digest", "record_type", "refers_to"])):
        assert rows_of(run(clashing(pages)), columns) == rows_of(run(pages), columns)


def test_vectors(spark):
    rng = random.Random(7)
    rows = spark.createDataFrame([(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(30)] + [(None, None)], "vec_id long, embedding array<double>")
    columns = ["vec_id", "component", "n", "deviation", "explained"]
    assert rows_of(whitening.components(clashing(rows).drop("hits")), columns) == rows_of(whitening.components(rows), columns)


def test_very_long_page(spark):
    """A payload of several megabytes that does not compress, among small ones, read back whole."""
    rng = random.Random(43)
    long = "<p>" + "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(5_000_000))
    pages = spark.createDataFrame([(1, "u", long), (2, "u", "<p>x"), (3, "u", long)], "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert {i: (r.record_type, r.refers_to, r.payload_bytes) for i, r in got.items()} == {1: ("revisit", 3, len(long)), 2: ("response", None, 4), 3: ("response", None, len(long))}
    assert bytes(got[3].payload) == long.encode()


def test_conversations(spark):
    rows = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", None), (None, 0, None, "x")], "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_sha256", "formatted_chars"]
    assert rows_of(chat.read_back(*chat.build(clashing(rows))), columns) == rows_of(chat.read_back(*chat.build(rows)), columns)
