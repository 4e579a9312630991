"""Nearest-neighbour information, isotonic pools, splits and areas against plain versions."""

import datetime as dt
import math

import numpy as np
import pytest

from fundalake.operators import features, isotonic, landing, models, screener


def plain_mi(x, y, k=3):
    def digamma(v):
        return math.log(v + 10) - 1 / (2 * (v + 10)) - 1 / (12 * (v + 10) ** 2) + 1 / (120 * (v + 10) ** 4) - 1 / (252 * (v + 10) ** 6) - sum(1 / (v + i) for i in range(10))

    x, y = np.array(x), np.array(y)
    size = np.array([(y == c).sum() for c in y])
    x, y, size = x[size > 1], y[size > 1], size[size > 1]
    total = []
    for i in range(len(x)):
        kk = min(k, size[i] - 1)
        r = np.sort(np.abs(x[y == y[i]] - x[i]))[kk]  # the first is the row itself
        m = (np.abs(x - x[i]) < r).sum() if r else (x == x[i]).sum()
        total.append(digamma(len(x)) + digamma(kk) - digamma(size[i]) - digamma(m))
    return max(0.0, float(np.mean(total)))


@pytest.mark.parametrize("slot", [5, 4096])
def test_nearest_neighbour_information(spark, slot):
    rng = np.random.default_rng(slot)
    y = rng.integers(0, 2, 300)
    columns = {"shifted": rng.standard_normal(300) + y, "noise": rng.standard_normal(300), "whole": rng.integers(0, 9, 300).astype(float), "same": np.ones(300), "skewed": np.exp(3 * rng.standard_normal(300)) * (1 + y)}
    y[:1], y[1:3] = 7, 8  # a class of one, and one smaller than k
    rows = [(*(float(v[i]) for v in columns.values()), int(y[i])) for i in range(300)] + [(None, 1.0, 1.0, 1.0, 1.0, 0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", target_bankruptcy int").repartition(5)
    got = {r.feature: r.score for r in features.select_mi(df, list(columns), slot=slot).collect()}
    assert got.keys() == columns.keys()
    for c, x in columns.items():
        assert abs(got[c] - plain_mi(x, y)) < 1e-9, c


def plain_isotonic(x, y, w):
    keys = sorted(set(x))
    pools = [[k, k, sum(c for a, c in zip(x, w) if a == k), sum(b * c for a, b, c in zip(x, y, w) if a == k)] for k in keys]
    while True:
        i = next((i for i in range(len(pools) - 1) if pools[i][3] / pools[i][2] >= pools[i + 1][3] / pools[i + 1][2]), None)
        if i is None:
            return pools
        a, b = pools[i], pools.pop(i + 1)
        pools[i] = [a[0], b[1], a[2] + b[2], a[3] + b[3]]


@pytest.mark.parametrize("slot", [3, 1 << 16])
def test_isotonic_pools(spark, slot):
    rng = np.random.default_rng(5)
    x = [float(v) for v in rng.integers(0, 60, 400) / 64]
    y = [float(rng.random() < v) for v in x]
    w = [float(v) for v in rng.integers(1, 4, 400)]
    df = spark.createDataFrame(list(zip(x, y, w)) + [(None, 1.0, 1.0), (0.5, None, 1.0), (0.5, 1.0, 0.0)], "s double, y double, w double").repartition(6)
    model = isotonic.fit(df, "s", "y", "w", slot=slot)
    pools = plain_isotonic(x, y, w)
    knots = sorted((r.x, r.value) for r in model.knots.collect())
    want = sorted({(e, p[3] / p[2]) for p in pools for e in p[:2]})
    assert len(knots) == len(want) and all(abs(a[0] - b[0]) + abs(a[1] - b[1]) < 1e-12 for a, b in zip(knots, want))
    new = [-1.0, 0.0, 0.013, 0.31, 0.5, 0.77, 0.9999, 5.0]
    got = {r.s: r.p for r in model.apply(spark.createDataFrame([(v,) for v in new] + [(None,)], "s double"), "s", "p").collect()}
    assert got.pop(None) is None
    for v in new:
        assert abs(got[v] - np.interp(v, *zip(*want))) < 1e-12


def test_walk_forward_keeps_the_embargo(spark):
    days = [dt.date(2015 + m // 12, 1 + m % 12, 1) for m in range(60)]
    df = spark.createDataFrame([(t, d) for t in "ab" for d in days], "ticker string, date date")
    rows = features.walk_forward(df, 4, 12).collect()
    for fold in (1, 2, 3, 4):
        test = {r.date for r in rows if r.fold == fold and r.side == "test"}
        train = {r.date for r in rows if r.fold == fold and r.side == "train"}
        assert len(test) == 12 and test == set(days[12 * fold : 12 * fold + 12])
        assert train == set(days[: 12 * fold - 11])
    assert features.walk_forward(df.limit(0), 4).count() == 0


def test_random_split_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(f"T{i}", dt.date(2020, 1 + i % 12, 1)) for i in range(2000)] + [(None, None)], "ticker string, date date")
    a, b = ({(r.ticker, r.date): r.split for r in features.random_split(d).collect()} for d in (df, df.repartition(7)))
    assert a == b and 330 < sum(v == "test" for v in a.values()) < 470
    assert a != {(r.ticker, r.date): r.split for r in features.random_split(df, seed=1).collect()}


def test_areas(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 1), (0.3, 0), (0.1, 0)]
    got = models.metrics(spark.createDataFrame(rows, f"score double, {models.LABEL} int")).first()
    assert abs(got.roc_auc - 7.5 / 9) < 1e-12
    assert abs(got.pr_auc - (1 + 2 / 3 + 3 / 4) / 3) < 1e-12


@pytest.mark.parametrize("name", screener.PRESETS)
def test_presets_at_their_bounds(spark, name):
    """A row that meets all bounds of a preset, one on each bound, and one just beyond each."""
    step, conditions = 1e-6, screener.PRESETS[name]
    inside = {"<": lambda c: c.value - step, ">": lambda c: c.value + step, "between": lambda c: (c.value + c.value2) / 2}
    meets = {c.column: float(inside[c.op](c)) for c in conditions}
    rows = [("yes", meets)]
    for i, c in enumerate(conditions):
        if c.op == "between":
            rows += [(f"yes{i}a", meets | {c.column: float(c.value)}), (f"yes{i}b", meets | {c.column: float(c.value2)}), (f"no{i}a", meets | {c.column: c.value - step}), (f"no{i}b", meets | {c.column: c.value2 + step})]
        else:
            rows += [(f"no{i}a", meets | {c.column: float(c.value)}), (f"no{i}b", meets | {c.column: c.value + (step if c.op == "<" else -step)})]
        rows.append((f"no{i}null", meets | {c.column: None}))
    df = spark.createDataFrame([(t, dt.date(2020, 1, 1), *[r.get(c) for c in meets]) for t, r in rows], "ticker string, date date, " + ", ".join(f"{c} double" for c in meets))
    got = {r.ticker for r in screener.scan(df, preset=name, date=None).collect()}
    assert got == {t for t, _ in rows if t.startswith("yes")}


def test_first_of_new_rows_by_their_other_columns(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k string, v int, w string")
    new = frame([("a", 1, "x"), ("b", 2, "z"), ("b", 2, "y"), ("b", 3, "a"), (None, None, None), (None, 1, None)])
    for df in (new, new.repartition(5)):
        got = landing.merge_new(frame([("a", 9, "old")]), df, ["k"]).collect()
        assert sorted(map(str, map(tuple, got))) == sorted(["('a', 9, 'old')", "('b', 2, 'y')", "(None, 1, None)"])


PAGE = """<html><table class="other"><tr><td>no</td></tr></table><!-- <table class="report-table"> -->
<table class="wide report-table"><thead><tr><th></th><th colspan="2">2020/Q1 (mar 20)</th><th>2020/Q2&nbsp;(cze 20)</th></tr></thead><tbody>
<tr><td rowspan="2"><b>Przychody &amp; zyski</b></td><td><span class="value"><span class="pv"><span>1&nbsp;234</span></span></span><div>r/r +3%</div></td><td>2,5</td><td><table><tr><td>77</td></tr></table></td></tr>
<tr><td>8<td>9<td>10
<tr><td>Nieznane</td><td>1</td><td>1</td><td>1</td></tr></tbody></table><table class="report-table"><tr><td>later</td></tr></table></html>"""


def test_report_tables_as_grids(spark):
    from fundalake.functions.tables import grid

    got = {(r, c): t for r, c, t, _ in grid(PAGE, "report-table")}
    assert [got[0, c] for c in range(4)] == ["", "2020/Q1 (mar 20)", "2020/Q1 (mar 20)", "2020/Q2 (cze 20)"]
    assert [got[1, c] for c in range(4)] == ["Przychody & zyski", "1 234r/r +3%", "2,5", "77"]
    assert [got[2, c] for c in range(4)] == ["Przychody & zyski", "8", "9", "10"] and len(got) == 16
    assert grid("<table class=report-table><tr><td rowspan=0>a<td>b<tr><td>c", "report-table") == [(0, 0, "a", ""), (0, 1, "b", ""), (1, 0, "a", ""), (1, 1, "c", "")]
    pages = spark.createDataFrame([("A", PAGE), ("B", None), ("C", "<p>none"), ("A", PAGE)], "ticker string, html string")
    rows = sorted((r.concept, str(r.end_date), r.report_type, r.value) for r in landing.report_page_facts(pages, {"Przychody & zyski": "Revenues"}).collect())
    q1, q2 = ("Revenues", "2020-03-31", "Q1"), ("Revenues", "2020-06-30", "Q2")
    assert rows == sorted([(*q1, 1_234_000.0), (*q1, 2500.0), (*q2, 77_000.0), (*q1, 8000.0), (*q1, 9000.0), (*q2, 10_000.0)] * 2)
