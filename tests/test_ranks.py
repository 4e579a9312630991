import math
import random
from itertools import combinations

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from fundalake.operators import landing, models, ranks, stats
from fundalake.operators.asof import asof_join

VALUES = [0.0, -0.0, 1e-310, -1e-310, 1.5, 1.5, -7.25, 1e300, -1e300, math.inf, -math.inf, math.nan, 3.0, 3.0000000001]


def test_slots_follow_the_order(spark):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v double").withColumn("s", ranks.slot(F.col("v")))
    slots = [r.s for r in rows.orderBy("v").collect()]
    assert slots == sorted(slots)


def test_quantiles_equal_the_built_in_ones(spark):
    rng = random.Random(1)
    data = [(k, rng.choice([None, rng.gauss(0, 1) * 10 ** rng.randint(-3, 6), float(rng.randint(-3, 3))])) for k in ("a", "b", None) for _ in range(300)] + [("empty", None), ("one", 4.5)]
    rows = spark.createDataFrame(data, "k string, v double")
    ps = (0.0, 0.01, 0.25, 0.5, 0.9, 1.0)
    got = {r.k: r._p for r in ranks.quantiles(rows, ["k"], "v", ps).collect()}
    want = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, ps))).alias("q")).collect()}
    assert set(want) - set(got) == {"empty"} and want["empty"] is None
    for k in got:
        assert got[k] == pytest.approx(want[k], rel=1e-12)
    assert ranks.quantiles(rows.filter("k = 'empty'"), [], "v", ps).first()._p == [None] * len(ps)


def test_kendall_equals_all_pairs(spark):
    rng = random.Random(2)
    data = [(float(rng.randint(0, 40)), rng.choice([None, float(rng.randint(0, 25)), rng.random()]), 1.0) for _ in range(400)]
    got = {(r.a, r.b): r.correlation for r in stats.correlations(spark.createDataFrame(data, "x double, y double, z double"), ["x", "y", "z"], "kendall").collect()}
    both = [(x, y) for x, y, _ in data if y is not None]
    sign = lambda v: (v > 0) - (v < 0)
    s = nx = ny = 0
    for (x1, y1), (x2, y2) in combinations(both, 2):
        s += sign(x1 - x2) * sign(y1 - y2)
        nx += x1 != x2
        ny += y1 != y2
    assert got["x", "y"] == pytest.approx(s / math.sqrt(nx * ny), rel=1e-12)
    assert got["x", "z"] is None and got["y", "z"] is None


def test_area_and_report(spark):
    rows = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.4, 0), (0.1, 0), (0.1, 1)], f"score double, {models.LABEL} int")
    m = models.metrics(rows).first()
    assert m.roc_auc == pytest.approx((3 + 2.5 + 0.5) / 9) and (m.n, m.positives) == (6, 3)
    assert m.accuracy == pytest.approx(4 / 6)
    assert {r.label: (r.precision, r.recall, r.support) for r in models.report(rows).collect()} == {0: pytest.approx((2 / 3, 2 / 3, 3)), 1: pytest.approx((2 / 3, 2 / 3, 3))}


@pytest.mark.parametrize("method", ["sigmoid", "isotonic"])
def test_calibration_serves_new_rows(spark, method):
    rng = random.Random(3)
    data = [(f"T{i}", i, x, int(rng.random() < 1 / (1 + math.exp(-2 * x)))) for i in range(300) for x in (rng.gauss(0, 1),)]
    rows = spark.createDataFrame(data, f"ticker string, date int, x double, {models.LABEL} int")
    fitted = models.calibrate(models._pipeline(["x"], LogisticRegression(weightCol="weight", labelCol=models.LABEL)), rows, method, 3)
    assert len(fitted.pairs) == 3
    new = fitted.score(spark.createDataFrame([(-3.0,), (0.0,), (3.0,)], "x double")).orderBy("x").collect()
    low, middle, high = (r.calibrated for r in new)
    assert 0 <= low < middle < high <= 1 and new[0].asDict().keys() == {"x", "score", "calibrated"}


def test_copies_of_the_right_side_change_nothing(spark):
    left = spark.createDataFrame([(t, c, d) for t in "abcdef" for c in ("US", "PL", None) for d in range(10)], "t string, c string, d int")
    right = spark.createDataFrame([("US", 2, 1), ("US", 5, None), ("PL", 9, 3), (None, 1, 4)], "c string, at int, v int")
    plain, copied = (sorted(map(str, asof_join(left, right, ["c"], "d", "at", plan=p).collect())) for p in ("interval", "sliced"))
    assert plain == copied and len(plain) == 180


def test_ticker_maps(spark):
    rows = spark.createDataFrame([(1, "A", 3500, [" b ", "C"]), (2, "B", 3500, ["b"]), (3, "Index Fund", 3500, ["D"]), (4, "E", 3500, ["", "e"])], "cik int, name string, sic int, tickers array<string>")
    assert sorted(map(tuple, landing.ticker_ciks(rows).collect())) == [("B", 2), ("C", 1), ("E", 4)]
    assert sorted(map(tuple, landing.primary_tickers(rows).collect())) == [(1, "B"), (2, "B"), (4, "E")]
