import collections
import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundalake.llm import common, decontam, kn_model, langid, mixing, quality_rules, simhash, substring_dedup

VOCAB = [f"w{i}" for i in range(400)]


def prose(rng, n, words=VOCAB):
    return " ".join(rng.choice(words) for _ in range(n))


# ---- shared helpers


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x85 ", max_size=20)), max_size=6))
def test_words(texts):
    w = common.Words(*common.text_buffers(pa.array(texts, pa.string())))
    want = [(t or "").encode().split() for t in texts]
    assert np.diff(w.first).tolist() == [len(x) for x in want]
    flat = [x for d in want for x in d]
    assert [bytes(w.raw[a:b]) for a, b in zip(w.start, w.end)] == flat
    assert len(set(zip(flat, w.hashes.tolist()))) == len(set(flat)) == len(set(w.hashes.tolist()))


def test_windows():
    h = np.random.default_rng(1).integers(0, 3, 300).astype(np.uint64)
    for k in (1, 2, 5, 8, 35):
        got = common.windows(h, k)
        seen = {tuple(h[i : i + k]): got[i] for i in range(len(got))}
        assert len(got) == 300 - k + 1 and all(seen[tuple(h[i : i + k])] == got[i] for i in range(len(got))) and len(set(got.tolist())) == len(seen)


def test_count_words(spark):
    texts = ["", " ", "a", " a", "a ", "\n a\tb \x0b", None, "é\x85b c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r.n for r in df.select("i", common.count_words(F.col("t")).alias("n")).orderBy("i").collect()] == [len((t or "").encode().split()) for t in texts]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200), (7, 3)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 103: 100}


# ---- language


def test_language(spark, docs, odd, empty):
    rng = random.Random(3)
    sets = {"aa": [f"{c}a{d}o" for c in "bcdfg" for d in "lmnrs"], "bb": [f"{c}ui{d}ek" for c in "hjkpq" for d in "tvwxz"]}
    rows = [(i, prose(rng, 40, sets[lang]), lang, "s") for i, lang in enumerate(["aa", "bb"] * 60)]
    df = docs(rows)
    model = langid.train(df.filter(~langid.held_out(F.col("doc_id"))))
    median = langid.medians(langid.predict(df, model), F.lit(True))
    got = langid.judged(langid.predict(df, model, whole=True), median).collect()
    assert all(r.doc.lang == r.lang_pred and 0.5 < r.score <= 1 and not r.rejected for r in got)
    rest = {r.doc_id: r for r in langid.judged(langid.predict(odd, model), median).collect()}
    assert [(rest[i].lang_pred, rest[i].score, rest[i].rejected) for i in (1, 2, 3, 6)] == [("und", 0.0, True)] * 4
    assert langid.predict(odd, model).count() == odd.count()
    assert langid.train(empty) == {} and langid.predict(empty, {}).count() == 0 and langid.accepted(empty).count() == 0
    assert {r.lang_pred for r in langid.predict(df, {}).collect()} == {"und"}
    assert langid.decide(["a", "b"], [1000, 1010], 2000) == ("a", pytest.approx(1, abs=0.001), 0.01, 0.5)
    more = [(900, None, "aa", "s"), (901, "".join(rng.choice("абвгдежзиклмнопр  ") for _ in range(400)), None, "s"), (902, " ".join(t for p in zip(rows[0][1].split(), rows[1][1].split()) for t in p), None, "s")]
    clash = df.unionByName(docs(more)).withColumns({c: F.lit(c) for c in ("has", "doc", "lang_pred", "gap", "_lang", "rejected", "_text")})
    kept = langid.accepted(clash).collect()
    assert {r.doc_id for r in kept} - {902} == set(range(120)) and all(r.doc == "doc" and r.rejected == "rejected" for r in kept)


def test_languages_against_a_plain_version(spark):
    """Each piece encoded on its own and summed in plain Python: same winner, score, margins and rejection; what accepted() keeps is the rest."""
    import math
    import statistics

    import zstandard

    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    learned = ~langid.held_out(F.col("doc_id"))
    model = langid.train(d.filter(learned))
    rows = d.select("doc_id", "text", learned.alias("learned")).collect()
    params = zstandard.ZstdCompressionParameters.from_level(langid.LEVEL, write_content_size=0, write_checksum=0, write_dict_id=0)
    coders = {}
    for k, v in model.items():
        known = zstandard.ZstdCompressionDict(v, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=langid.LEVEL)
        coders[k] = zstandard.ZstdCompressor(dict_data=known, compression_params=params)
    coders[""] = zstandard.ZstdCompressor(compression_params=params)
    plain = {}
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            plain[r.doc_id] = ("und", 0.0, None, None)
            continue
        raw = r.text.lower().encode()
        size = {k: sum(len(c.compress(raw[i : i + 768])) for i in range(0, len(raw), 768)) for k, c in coders.items()}
        none = size.pop("")
        order = sorted(size, key=lambda k: (size[k], k))
        least = size[order[0]]
        plain[r.doc_id] = (order[0], 1 / math.fsum(2.0 ** -min(60, v - least) for v in size.values()), (size[order[1]] - least) / least, 1 - least / none)
    found = langid.predict(d, model)
    got = {r.doc_id: (r.lang_pred, r.score, r.gap, r.gain) for r in found.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in plain.items()}
    assert all(got[k][1:] == (v[1:] if v[2] is None else pytest.approx(v[1:])) for k, v in plain.items())
    middle = {}
    for lang in model:
        mine = [plain[r.doc_id] for r in rows if r.learned and plain[r.doc_id][0] == lang]
        middle[lang] = [statistics.median_low([x[i] for x in mine]) for i in (2, 3)]
    wanted = {k for k, (lang, _, gap, gain) in plain.items() if gap is not None and gap > 0.05 * middle[lang][0] and gain > 0.05 * max(middle[lang][1], 0)}
    assert {r.doc_id for r in langid.accepted(d).collect()} == wanted and 0 < len(wanted) < len(plain)



def test_held_out_accuracy(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    got = langid.predict(d, langid.train(d.filter(~held)), whole=True).filter(held).select("lang_pred", "doc.lang")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.95


# ---- near-duplicates


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    s = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB cÉ\n", max_size=60), st.integers(0, 400))
def test_fingerprint(text, more):
    text = text + " x y" * more
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def slow_components(fps, radius=4):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("leaf_rows, wide", [(8192, 1 << 27), (4, 1 << 27), (1, 0)])
def test_links_find_all(spark, leaf_rows, wide):
    """Chains and balls around centres; small leaves make deep trees, and beyond ``wide`` shards are pairs of leaves."""
    rng = random.Random(5)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for c in list(fps)[:15]:
        x = c
        for _ in range(12):
            for b in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    edges = simhash.links(df, leaf_rows=leaf_rows, wide=wide).collect()
    got = collections.defaultdict(set)
    roots = {r.node: r.component for r in common.components(spark.createDataFrame([(r.a, r.b) for r in edges], "a long, b long")).collect()}
    for x in fps:
        s = signed(x)
        got[roots.get(s, s)].add(x)
    want = collections.defaultdict(set)
    for x, r in zip(fps, slow_components(fps)):
        want[r].add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_vantage_point_tree(radius):
    """Values within the radius share a leaf; no leaf is larger than the whole, and leaves are many."""
    rng = np.random.default_rng(radius)
    values = np.unique(np.concatenate([rng.integers(0, 1 << 16, 700), 777 ^ (1 << rng.integers(0, 16, 40))]))
    weights = np.zeros(1 << 16)
    weights[values] = rng.integers(1, 9, len(values))
    t = simhash.Tree(weights, radius, 100)
    at = {v: set(t.leaves[t.first[v] : t.first[v + 1]].tolist()) for v in values.tolist()}
    assert all(at[a] & at[b] for a in at for b in at if (a ^ b).bit_count() <= radius)
    load = collections.Counter(x for v in at for x in at[v] for _ in range(int(weights[v])))
    assert len(load) > 5 and max(load.values()) < weights.sum() / 2


def test_near_duplicates(spark, docs, odd, empty):
    rng = random.Random(7)
    a = prose(rng, 3000)
    rows = [(10, a, "en", "s"), (11, a.upper(), "en", "s"), (12, a.replace("w17 ", "zz ", 1), "en", "s"), (13, prose(rng, 300), "en", "s")]
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs(rows)).collect()}
    assert got == {10: 10, 11: 10, 12: 10, 13: 13}
    rest = simhash.near_duplicates(odd).collect()
    assert len(rest) == 8 and {r.component_id for r in rest if r.doc_id in (1, 2, 3)} == {1}
    assert [r.component_id for r in rest if r.doc_id is None] == [None]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6]


def test_one_row_of_each_group_with_null_and_shared_ids(docs):
    rng = random.Random(8)
    texts = [prose(rng, 300) for _ in range(12)]
    ids = [None] * 6 + [7] * 3 + [20, 21, 22]
    rows = [(i, t, "en", "s") for i, t in zip(ids, texts)] + [(None, texts[0], "en", "s"), (30, texts[1], "en", "s"), (31, texts[9].upper(), "en", "s")]
    want = list(zip([None, 30, *ids[2:]], texts))
    got = [(r.doc_id, r.text) for r in simhash.deduplicated(docs(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aB cÉ\n", max_size=60), max_size=4), st.sampled_from([0, 1, 400]))
def test_signatures(texts, more):
    texts = [x + " x Y" * more for x in texts]
    got = simhash.text_signatures(*common.text_buffers(pa.array(texts, pa.string())))
    for text, sig in zip(texts, got):
        h = common.Words(*common.text_buffers(pa.array([text.encode().lower().decode()]))).hashes
        s = common.windows(h, min(5, len(h))) if len(h) else h
        remixed = [common.mix(s ^ common.mix(np.array([k + 1], np.uint64))[0]).tolist() for k in range(8)]
        assert sig.tolist() == [sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in r) > len(r)) for r in remixed]


@pytest.mark.parametrize("leaf_rows, wide", [(8192, 1 << 27), (4, 1 << 27), (1, 0)])
def test_signature_links_find_all(spark, leaf_rows, wide):
    """Chains that leave a fingerprint's radius, that keep it but leave the bits of all, and signatures that share a whole fingerprint."""
    rng = random.Random(11)
    sigs = {tuple(rng.getrandbits(64) for _ in range(8)) for _ in range(40)}
    for c in sorted(sigs)[:14]:
        x = list(c)
        for _ in range(10):
            for k in range(8):
                for b in rng.sample(range(64), rng.randint(0, 14)):
                    x[k] ^= 1 << b
            sigs.add(tuple(x))
            x = x if rng.random() < 0.6 else [*x[:1], *(rng.getrandbits(64) for _ in range(7))]
    sigs = sorted(sigs)
    parent = list(range(len(sigs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n_links = 0
    for i, x in enumerate(sigs):
        for j, y in enumerate(sigs[:i]):
            d = [(a ^ b).bit_count() for a, b in zip(x, y)]
            if min(d[:6]) <= 7 and sum(d) <= 80:
                n_links += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = collections.defaultdict(set)
    for i, x in enumerate(sigs):
        want[root(i)].add(x)
    df = spark.createDataFrame([([signed(v) for v in x],) for x in sigs], "sig array<long>")
    edges = common.cut(simhash.signature_links(df, leaf_rows=leaf_rows, wide=wide))
    roots = {tuple(r.node): tuple(r.component) for r in common.components(edges).collect()}
    got = collections.defaultdict(set)
    for x in sigs:
        s = tuple(signed(v) for v in x)
        got[roots.get(s, s)].add(x)
    assert n_links > 50 and sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_near_copies_go_and_others_stay(docs):
    """Copies of likeness 0.9 in five-word shingles go, nearly all; of 0.84 at least three quarters (signatures estimate a likeness); texts that share half of them stay."""
    rng = random.Random(12)
    rows, gone = [], {3: set(), 5: set()}
    for i in range(40):
        words = [f"v{rng.randrange(5000)}" for _ in range(300)]
        rows.append((1000 * i, " ".join(words), "en", "s"))
        for c, n_changed in enumerate((3, 3, 5, 5), 1):
            copy = list(words)
            for at in rng.sample(range(10, 290, 10), n_changed):
                copy[at] = f"new{c}-{at}"
            rows.append((1000 * i + c, " ".join(copy), "en", "s"))
            gone[n_changed].add(1000 * i + c)
        rows.append((1000 * i + 9, " ".join(words[:200] + [f"u{rng.randrange(5000)}" for _ in range(100)]), "en", "s"))
    kept = {r.doc_id for r in simhash.deduplicated(docs(rows)).collect()}
    assert all(1000 * i in kept and 1000 * i + 9 in kept for i in range(40))
    assert len(kept & gone[3]) <= 2 and len(kept & gone[5]) <= 20


# ---- substrings


def slow_repeats(rows, width=35):
    words = [(t or "").encode().split() for _, t in rows]
    c = collections.Counter(tuple(w[i : i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (d, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - width + 1) if c[tuple(w[i : i + width])] > 1 for j in range(i, i + width)}
        out.append((d, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("group_rows", "set_rows"), [(4096, 1 << 20), (1, 1 << 20), (3, 0)])
def test_repeats(spark, docs, group_rows, set_rows):
    rng = random.Random(11)
    passage, other = prose(rng, 60), prose(rng, 35)
    rows = [(i, " ".join([prose(rng, rng.randint(0, 50)), passage if i % 2 else "", prose(rng, 20), other if i % 3 == 0 else ""]), "en", "s") for i in range(40)]
    rows += [(50, passage + " " + passage, "en", "s"), (51, "a " * 100, "en", "s"), (52, prose(rng, 34), "en", "s"), (53, rows[1][1], "en", "s"), (53, rows[1][1], "en", "s"), (54, "x y " * 40, "en", "s"), (55, None, "en", "s"), (56, "", "en", "s"), (None, other, "en", "s"), (57, prose(rng, 36), "en", "s")]
    rows += [(60, rows[52 - 10][1], "en", "s"), (61, rows[52 - 10][1], "en", "s")]
    got = substring_dedup.without_repeats(docs(rows), 35, group_rows, set_rows)
    assert got.columns == [*docs([]).columns, "kept_text", "n_words", "n_removed"]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str) == slow_repeats([(r[0], r[1]) for r in rows])


def test_repeats_odd(spark, odd, empty):
    got = substring_dedup.without_repeats(odd).collect()
    assert len(got) == 8 and {(r.doc_id, r.n_removed) for r in got if r.doc_id != 5} == {(i, 0) for i in (1, 2, 3, 4, None, 6)}
    assert [r.n_removed for r in got if r.doc_id == 5] == [30_000]
    assert substring_dedup.without_repeats(empty).count() == 0 and substring_dedup.applied(empty).count() == 0
    kept = {r.doc_id: r.text for r in substring_dedup.applied(odd).collect()}
    assert kept[5] == "end" and kept[3] == "  \n\t "


# ---- decontamination


@pytest.mark.parametrize("small_rows", [1 << 18, -1])
def test_overlaps(spark, docs, odd, empty, monkeypatch, small_rows):
    monkeypatch.setattr(common, "SMALL_ROWS", small_rows)
    rng = random.Random(13)
    item, short = prose(rng, 40), prose(rng, 7)
    bench = spark.createDataFrame([(1, item), (2, short), (3, None), (4, "a b"), (1, item)], "item_id long, text string")
    words = item.split()
    for i in range(5, 40, 8):
        words[i] = "changed"
    rows = [(10, prose(rng, 50) + " " + item.upper() + " " + prose(rng, 50)), (11, prose(rng, 30) + " " + ", ".join(words)), (12, prose(rng, 300)), (13, "a b c"), (14, prose(rng, 9) + " " + short), (15, " ".join(item.split()[:20])), (16, " ".join(item.split()[:10])), (17, "A, b!"), (17, "A, b!"), (None, item)]
    got = {r.doc_id: r for r in decontam.report(docs([(*r, "en", "s") for r in rows]), bench).collect()}
    assert {d for d, r in got.items() if r.contaminated} == {10, 11, 14, 15, 17, None}
    assert got[10].item_ids == [1] and got[10].longest == 40 and got[14].item_ids == [2] and got[17].item_ids == [4]
    assert decontam.report(odd, bench).filter("contaminated").count() == 0 and decontam.report(odd, bench).count() == 8
    assert decontam.report(empty, bench).count() == 0
    df = docs([(*r, "en", "s") for r in rows]).withColumns({c: F.lit(c) for c in ("k1", "k2", "doc", "hits", "item", "seed")})
    assert decontam.clean(df, bench.limit(0)).count() == 10
    kept = decontam.clean(df, bench).collect()
    assert {r.doc_id for r in kept} == {12, 13, 16} and all(r.k1 == "k1" and r.doc == "doc" for r in kept)


def test_overlaps_against_all_stretches(spark, docs):
    rng = random.Random(14)
    cases = [(n, k) for n in (5, 6, 7, 8, 9, 10, 12, 13, 15, 16, 20, 25, 38) for k in range(n // 4 + 2) for _ in range(60)]
    items = [[f"i{c}t{j}" for j in range(n)] for c, (n, k) in enumerate(cases)]
    texts, want = [], set()
    for c, ((n, k), item) in enumerate(zip(cases, items)):
        gone = set(rng.sample(range(n), k))
        texts.append(" ".join(["pad"] * rng.randrange(3) + [f"x{j}" if j in gone else t for j, t in enumerate(item)] + ["pad"] * rng.randrange(3)))
        if any(5 * sum(x not in gone for x in range(a, b)) >= 4 * (b - a) for a in range(n) for b in range(a + min(n, 13), n + 1)):
            want.add(c)
    bench = spark.createDataFrame([(c, " ".join(i)) for c, i in enumerate(items)], "item_id long, text string")
    df = docs([(c, t, "en", "s") for c, t in enumerate(texts)])
    got = {(r.doc_id, i) for r in decontam.report(df, bench).collect() for i in r.item_ids}
    assert got == {(c, c) for c in want} and 0 < len(want) < len(cases)
    assert all(r.equal >= 0.8 * r.overlap for r in decontam.overlaps(df, bench).collect())


def test_longest_overlap_against_all_stretches():
    """Random texts over few words, so that seeds meet on many diagonals."""
    rng = np.random.default_rng(15)
    some = 0
    for _ in range(400):
        words = rng.integers(1, 1 << 63, rng.integers(1, 5)).astype(np.uint64)
        h, item = (words[rng.integers(0, len(words), n)] for n in (rng.integers(1, 60), rng.integers(1, 30)))
        seed, at = decontam.item_seeds(item)
        met = decontam.diagonals(decontam.text_seeds(h), len(h), (seed, at), len(item))
        got = decontam.overlap(h, item, met)
        n, m, best = len(h), len(item), 0
        for s in range(-m, n):
            equal = [0 <= s + j < n and h[s + j] == item[j] for j in range(m)]
            inside = [j for j in range(m) if 0 <= s + j < n]
            for a in inside:
                for b in range(a + 1, inside[-1] + 2):
                    if 5 * sum(equal[a:b]) >= 4 * (b - a) and (m >= 5 or (n == m and s == 0)):
                        best = max(best, b - a)
        want = best if best >= min(m, 13) else 0
        assert (got[1] - got[0] if got else 0) == want
        some += want > 0
        assert got is None or 5 * got[2] >= 4 * (got[1] - got[0])
    assert 50 < some < 400


@pytest.mark.parametrize("rows", [1 << 12, 7])
def test_repetitive_texts_meet_repetitive_items_once(spark, docs, monkeypatch, rows):
    """All texts and items repeat one phrase; a text's items may be dealt over several rows."""
    monkeypatch.setattr(decontam, "ITEMS_PER_ROW", rows)
    phrase = "one two three four five six seven"
    bench = spark.createDataFrame([(i, f"{phrase} " * 4 + f"end{i}") for i in range(40)], "item_id long, text string")
    df = docs([(i, f"{phrase} " * 34 + f"tail{i}", "en", "s") for i in range(300)])
    got = decontam.report(df, bench).collect()
    assert len(got) == 300 and all((r.n_overlaps, r.n_items, r.item_ids) == (40, 40, list(range(40))) and r.longest >= 28 for r in got)


def test_leaks_of_the_test_tables(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    b = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [r.text for r in b.collect()]
    want = {r.doc_id for r in d.collect() if any(t in r.text for t in items)}
    assert {r.doc_id for r in decontam.report(d, b).filter("contaminated").collect()} == want


# ---- rules


def test_rules(spark, docs, odd, empty):
    rng = random.Random(17)
    rows = [(i, prose(rng, 80), "en", "s") for i in range(150)]
    bad = [(200, prose(rng, 5), "en", "s"), (201, "a b c d e " * 10, "en", "s"), (202, " ".join(w + "###$$$" for w in prose(rng, 80).split()), "en", "s"), (203, "\n".join(["l m"] * 5 + [prose(rng, 5) for _ in range(12)]), "en", "s")]
    got = {r.doc_id: r for r in quality_rules.verdicts(docs(rows + bad)).collect()}
    assert all(got[i].kept for i in range(150)) and not any(got[i].kept for i in (200, 201, 202, 203))
    assert got[200].base_failed and got[201].base_failed and not got[202].base_failed and got[203].n_dup_lines == 4
    assert (got[201].n_repeat_words, got[202].n_symbols) == (50, 480)
    rest = quality_rules.verdicts(odd).collect()
    assert len(rest) == 8 and {r.n_words for r in rest if r.doc_id in (1, 2, 3)} == {0} and all(r.base_failed for r in rest if r.doc_id != 5)
    assert [(r.n_words, r.word_chars) for r in rest if r.doc_id == 5] == [(30_001, 30_003)]
    assert quality_rules.verdicts(empty).count() == 0


def test_buckets(spark):
    df = spark.range(0, 5000).withColumn("_x", F.col("id")).withColumn("_b", quality_rules.bucket(F.col("_x"))).withColumn("lo", quality_rules.bucket_floor(F.col("_b")))
    rows = df.orderBy("id").collect()
    assert all(r.lo <= r.id <= r.lo * (1 + 1 / 32) + 1 for r in rows)
    assert all(a["_b"] <= b["_b"] for a, b in zip(rows, rows[1:]))


# ---- language model


def slow_model(texts, test, n_max=kn_model.ORDER):
    low = lambda t: bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode())
    pad = lambda t: [0] * (n_max - 1) + list(low(t)) + [0]
    c = {n_max: collections.Counter(tuple(x[i - n_max + 1 : i + 1]) for x in map(pad, texts) for i in range(n_max - 1, len(x)))}
    for n in range(n_max - 1, 0, -1):
        c[n] = collections.Counter(k[1:] for k in c[n + 1])
    disc, ctx = {}, {n: collections.defaultdict(lambda: [0, 0.0]) for n in c}
    for n in c:
        m = [0] + [sum(v == i for v in c[n].values()) for i in range(1, 5)]
        y = m[1] / (m[1] + 2 * m[2]) if m[1] else 0
        disc[n] = [max(0, min(i, i - (i + 1) * y * m[i + 1] / m[i])) if m[i] else 0.5 for i in (1, 2, 3)]
        for k, v in c[n].items():
            ctx[n][k[:-1]][0] += v
            ctx[n][k[:-1]][1] += disc[n][min(v, 3) - 1]

    def p(k):
        if not k:
            return 1 / 256
        n = len(k)
        if k[:-1] not in ctx[n]:
            return p(k[1:])
        total, given = ctx[n][k[:-1]]
        v = c[n].get(k, 0)
        return (v - disc[n][min(v, 3) - 1] if v else 0) / total + given / total * p(k[1:])

    return [sum(math.log(p(tuple(x[i - n_max + 1 : i + 1]))) for i in range(n_max - 1, len(x))) for x in map(pad, test)]


def folds_of(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, text string").select("i", kn_model._fold().alias("f")).collect()
    return [f for _, f in sorted((r.i, r.f) for r in rows)]


@pytest.mark.parametrize(("shard", "chunk"), [(1 << 20, 1 << 20), (300, 500)])
def test_kneser_ney(spark, docs, shard, chunk):
    """Each text by the model of the other fold, in one chunk and one shard for each partition or in many; copies and shared or null ids keep their own scores."""
    rng = random.Random(19)
    texts = [prose(rng, 30) + " Éa" for _ in range(20)]
    test = [(0, texts[0]), (1, texts[1]), (2, "zebra! " + prose(rng, 5)), (3, ""), (4, "ÀÉ\n"), (5, None), (0, texts[0]), (None, "qqqq zzzz"), (None, "w1 w2 w3 "), (0, prose(rng, 700))]
    model = kn_model.train(docs([(i, t, "en", "s") for i, t in enumerate(texts)]))
    rows = kn_model.scores(docs([(i, t, "en", "s") for i, t in test]), model, chunk, shard).collect()
    of, mine = folds_of(spark, texts), folds_of(spark, [t or "" for _, t in test])
    assert len(set(of)) == len(set(mine)) == 2
    want = sorted((i or -1, len((t or "").encode()), round(slow_model([x for x, f in zip(texts, of) if f != own], [t or ""])[0], 2)) for (i, t), own in zip(test, mine))
    assert sorted((r.doc_id or -1, r.n_bytes, round(r.log_p, 2)) for r in rows) == [(i, n, pytest.approx(p, rel=1e-4, abs=0.02)) for i, n, p in want]


def test_probabilities_sum_to_one(spark, docs):
    texts = [f"abracadabra abc {i} cab" for i in range(6)]
    t = kn_model.train(docs([(i, x, "en", "s") for i, x in enumerate(texts)])).toArrow()
    shard = kn_model.Shard(t["fold"].to_numpy(), t["kind"].to_numpy(), t["k"].to_numpy().view(np.uint64), t["v"].to_numpy())
    for fold in set(folds_of(spark, texts)):
        for context in (0x6162726163, 0x7A7A7A7A7A, 0):
            k = (np.uint64(context) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
            assert np.exp(kn_model.log_p(fold, k, shard, shard)).sum() == pytest.approx(1, rel=1e-4)


def test_classify(spark, docs, odd, empty):
    rng = random.Random(23)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(100)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(i, prose(rng, 60), "en", "s") for i in range(120)] + [(500, "".join(chr(rng.randint(200, 600)) for _ in range(300)), "en", "s"), (501, prose(rng, 60), None, "s")]
    scored = kn_model.classify(docs(rows), labels).collect()
    got = {r.doc_id: r.kept for r in scored}
    assert not got[500] and sum(got[i] for i in range(120)) >= 110
    # thresholds and verdicts against sorted lists: by length where 50 trusted texts have it, else by language, else by all
    octave = lambda r: (r.n_bytes + 1).bit_length() - 1
    for r in scored:
        sets = [[x.perplexity for x in scored if x.doc_id in range(100) and (level > 1 or x.lang == r.lang) and (level > 0 or octave(x) == octave(r))] for level in range(3)]
        group = sorted(next(g for i, g in enumerate(sets) if i == 2 or len(g) >= kn_model.MIN_TRUSTED))
        low, high = (group[max(0, math.ceil(q * len(group)) - 1)] for q in kn_model.QUANTILES)
        assert (r.low, r.high, r.kept) == (low, high, low <= r.perplexity <= high)
    assert kn_model.classify(odd, labels).count() == 8
    none = kn_model.classify(odd, labels.limit(0)).collect()
    assert all(r.kept and r.high is None for r in none) and none[0].perplexity == pytest.approx(256)
    assert kn_model.classify(empty, labels).count() == 0


# ---- mixing


def fill(sizes, cap=3):
    """Targets by going round: share by weight, cut what is above, share the rest again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = total - sum(full.values())
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        full |= {s: cap * sizes[s] for s in over}


def test_mix(spark, docs, odd, empty):
    rng = random.Random(29)
    sizes = {"b": 900, "a": 30, "c": 40, None: 300, "é": 5, "d": 0}
    rows = []
    for s, n in sizes.items():
        for i in range(n):
            rows.append((len(rows), prose(rng, rng.randint(0, 40)), "en", s))
    rows.append((99_999, None, "en", "d"))
    got = mixing.mix(docs(rows)).join(docs(rows).select("doc_id", "source"), "doc_id").collect()
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    want = fill({s: sum(r.size for r in v) for s, v in by.items()})
    for s, v in by.items():
        assert v[0].target == pytest.approx(want[s]) and all(r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0 for r in v)
        assert abs(sum(r.taken for r in v) - want[s]) <= max(40, 0.02 * want[s])
    again = mixing.mix(docs(rows)).select("doc_id", "taken").collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in got}
    assert mixing.mix(odd).count() == 8 and mixing.mix(empty).count() == 0 and mixing.ordered(empty).count() == 0
    order = mixing.ordered(docs(rows)).select("doc_id", "copy", "position", "source").collect()
    assert len(order) == sum(r.copies for r in got) and all(0 <= r.position <= 1 for r in order)
    # heavy sources come later than light ones
    mean = lambda s: np.mean([r.position for r in order if r.source == s])
    assert mean("a") < mean("b") < mean("c")


def test_order_with_null_and_shared_ids(docs):
    rng = random.Random(30)
    rows = [(rng.choice([None, 1, 2, i]), f"t{i} " + prose(rng, rng.randint(3, 30)), "en", rng.choice("abc")) for i in range(400)]
    df = docs(rows)
    plan, order = mixing.mix(df).collect(), mixing.ordered(df).collect()
    copies = collections.defaultdict(list)
    for r in order:
        copies[r.text].append(r.copy)
    ids = {t: (i, s) for i, t, _, s in rows}
    assert all(sorted(c) == list(range(len(c))) for c in copies.values())
    assert sorted((ids[t][0] or -1, len(t.split()), len(c)) for t, c in copies.items()) == sorted((r.doc_id or -1, r["size"], r.copies) for r in plan if r.copies)
    assert all((r.doc_id, r.source) == ids[r.text] for r in order)


def test_equal_rows_are_all_taken(spark, docs):
    rows = [(1, "a b c", "en", "s")] * 5 + [(1, "a b c", "de", "s"), (None, None, None, "s"), (1, "c", "en", "t")]
    plan = sorted((r["size"], r.copies) for r in mixing.mix(docs(rows)).collect())
    order = collections.Counter((r.doc_id, r.text, r.lang) for r in mixing.ordered(docs(rows)).collect())
    assert sum(order.values()) == sum(c for _, c in plan) and order[1, "a b c", "en"] >= 5 * order[1, "a b c", "de"] - 5


def test_positions(spark, docs):
    """Positions against the demand curve added up document by document, and names that clash."""
    rng = random.Random(31)
    rows = [(i, prose(rng, rng.randint(0, 30)), "en", "abcd"[min(3, i % 7)]) for i in range(300)]
    df = docs(rows).withColumns({c: F.lit(c) for c in ("row", "k", "doc", "copies", "start", "passes", "bucket", "sid", "more", "position", "copy")})
    order = mixing.ordered(df).collect()
    assert [r.position for r in order] == sorted(r.position for r in order) and all(r.row == "row" and r.k == "k" and r.bucket == "bucket" for r in order)
    got = {r.doc_id: r for r in mixing.mix(df).collect()}
    place = lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i)
    for rank, s in enumerate("abcd"):
        size = {i: len(t.split()) for i, t, _, x in rows if x == s}
        total, target, weight = sum(size.values()), got[next(iter(size))].target, rank % 3 + 1
        start = 0
        w0, w1 = weight * (1 - (weight - 2) / 4), weight * (1 + (weight - 2) / 4)
        asked = lambda t: (w0 * t + (w1 - w0) * t * t / 2) / weight * target  # noqa: E731, B023
        for i in sorted(size, key=place):
            copies = sorted((r for r in order if r.doc_id == i), key=lambda r: r.copy)
            for c, r in enumerate(copies):
                assert asked(r.position) == pytest.approx(min(c * total + start, target), abs=1e-6 * target)
            if copies:
                assert (got[i].first_position, got[i].last_position) == (copies[0].position, copies[-1].position)
            assert got[i].copies == len(copies) and got[i].taken == len(copies) * size[i]
            start += size[i]


def test_schedule(spark):
    knots = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in ((0.0, 1.0), (0.5, 3.0), (0.5, 0.0), (1.0, 2.0))])
    segs = mixing.segments(knots)
    df = spark.range(0, 101).select((F.col("id") / 100).alias("q"), mixing.integral(segs).alias("all")).withColumn("t", mixing.invert(segs, F.col("q") * F.col("all")))
    rows = df.orderBy("q").collect()
    area = lambda t: t + 2 * t * t if t <= 0.5 else 1.0 + 2 * (t - 0.5) ** 2
    assert rows[0]["all"] == pytest.approx(1.5) and all(area(r.t) == pytest.approx(1.5 * r.q, abs=1e-9) for r in rows)
