import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundalake.llm import chat, common, simhash

KIND = "conv_id long, turn long, role string, text string, node string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<", ">", "/", "s", "[", "]", "INST", "\\", "0", "5", "role", "\n", "é", "<s>", "[/INST]"]), max_size=30).map("".join))
def test_escape(text):
    e = chat.escape(text)
    assert chat.unescape(e) == text and not any(c in e for c in chat.CONTROL)


def test_tree(spark):
    hard = "</s>[INST] ok [/INST] \\1 <s>"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "hi"), (2, 1, "assistant", "yo"), (2, 2, "user", "more"), (3, 0, "user", "hi"), (3, 1, "assistant", hard), (4, 5, "assistant", None), (4, 2, None, ""), (5, 0, "user", "other"), (6, 0, "user", "hi"), (6, 0, "user", "hi"), (7, 0, "system", "x " * 20_000), (None, 0, "user", "hi"), (8, 1, "assistant", "yo"), (8, 0, "user", "hi")]
    rows += [(9, i, "user", f"turn {i}") for i in range(300)]  # a long one has one interval above each turn
    df = spark.createDataFrame([(*r, "clash") for r in rows], KIND)
    stream, leaves = chat.build(df)
    nodes = chat.sorted_stream(stream).collect()
    at = 0
    for n in nodes:  # one stream, each shared turn once
        assert (n.start, n.stop - n.start) == (at, len(n.tokens)) and len(n.positions) == len(n.tokens)
        assert n.positions[0] == sum(x.stop - x.start for x in n.attends) and len(n.attends) <= n.depth
        at = n.stop
    assert len(nodes) == 309 and max(len(n.attends) for n in nodes) <= 2
    open_ = []  # depth first: ancestors are the open nodes
    for n in nodes:
        open_ = open_[: n.depth]
        joined = []
        for a, b in open_:
            joined = [*joined[:-1], (joined[-1][0], b)] if joined and joined[-1][1] == a else [*joined, (a, b)]
        assert [(x.start, x.stop) for x in n.attends] == joined
        open_.append((n.start, n.stop))
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, r or "", x or ""))
    got = {r.conv_id: r for r in chat.read_back(stream, leaves).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        said = "".join(x for _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(said), sha(said))


def test_long_conversation(spark):
    """10,000 turns, a second conversation that leaves the first half-way, and rows without a conversation."""
    n = 10_000
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(n)] + [(2, i, "user" if i % 2 else "assistant", f"t{i}" if i < n // 2 else f"u{i}") for i in range(n // 2 + 3)]
    rows += [(None, 0, "user", "alone"), (None, 1, "user", "too"), (None, 1, "user", "too"), (3, 0, "assistant", "long " * 200_000)]
    stream, leaves = chat.build(spark.createDataFrame([(*r, "clash") for r in rows], KIND).withColumns({"conv": F.lit(1), "depth": F.lit("x"), "run": F.lit("y")}))
    stream = stream.persist()
    nodes = stream.select("depth", "start", "stop", F.size("attends").alias("n"), F.col("positions")[0].alias("first")).orderBy("start").collect()
    assert len(nodes) == n + 3 + 2 + 1 and [x.start for x in nodes] == [0, *[x.stop for x in nodes][:-1]]
    assert max(x.n for x in nodes) <= 3 and max(x.depth for x in nodes) == n - 1
    got = collections.defaultdict(list)
    for r in chat.read_back(stream, leaves).collect():
        got[r.conv_id].append((r.n_turns, r.turns_sha256))
    sha = lambda c: hashlib.sha256("".join(f"{r}\n{x}\n" for i, _, r, x in rows if i == c).encode()).hexdigest()
    assert [got[c] for c in (1, 2, 3)] == [[(n, sha(1))], [(n // 2 + 3, sha(2))], [(1, sha(3))]]
    assert sorted(x for x, _ in got[None]) == [1, 1, 1]


def test_no_conversations(spark):
    assert chat.read_back(*chat.build(spark.createDataFrame([], KIND))).count() == 0


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage, and after each."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = [spark.read.parquet(f"{sf}/documents.parquet")]
    for _, f in corpus_pipeline.STAGES:
        out.append(f(spark, out[-1], sf).persist())
    return out


def test_pipeline(spark, stages):
    raw, known, single, cut, clean, mixed = [s.toPandas() for s in stages]
    for a, b in zip((raw, known, single, cut), (known, single, cut, clean)):
        assert list(b.columns) == list(raw.columns) and set(b.doc_id) <= set(a.doc_id) and b.doc_id.is_unique
    assert len(known) >= 0.97 * len(raw)
    from test_text_operators import slow_repeats

    sigs = simhash.text_signatures(*common.text_buffers(pa.array(known.text, pa.string())))
    root = np.arange(len(sigs))
    for i, sig in enumerate(sigs):
        differ = np.bitwise_count(sigs[:i] ^ sig)
        for j in np.flatnonzero((differ[:, :6].min(1) <= 7) & (differ.sum(1) <= 80)):
            root[root == root[i]] = root[j]
    assert sorted(single.doc_id) == sorted(known.doc_id.groupby(root).min())
    want = {d: (n, gone, t) for d, n, gone, t in slow_repeats(list(zip(single.doc_id, single.text)))}
    was = dict(zip(single.doc_id, single.text))
    assert dict(zip(cut.doc_id, cut.text)) == {d: t if gone else was[d] for d, (n, gone, t) in want.items() if not gone or gone < n}
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    assert set(cut.doc_id) - set(clean.doc_id) == {d for d, t in zip(cut.doc_id, cut.text) if any(i in t for i in items)}
    assert {"copy", "position"} <= set(mixed.columns) and set(mixed.doc_id) <= set(clean.doc_id)
    assert mixed.position.is_monotonic_increasing


def test_stages_with_odd_rows(spark, odd, empty):
    import corpus_pipeline

    for rows in (odd, empty):
        docs = rows
        for _, f in corpus_pipeline.STAGES:
            docs = f(spark, docs, "/root/testdata/sf0.001")
        docs.count()
