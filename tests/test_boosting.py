"""Boosted trees against a plain version that looks at every split by itself."""

import numpy as np

from fundalake.operators import boosting
from fundalake.operators.boosting import Settings


def plain_fit(model, bins, y, h, s):
    """Margins and trees, node by node."""
    margin, trees = np.zeros(len(y)), []
    for number in range(s.rounds):
        g, hs = boosting.gradients(y, np.where(y == 1, s.positive, 1.0), margin)
        row = boosting.taken_rows(h, s, number)
        columns = boosting.taken_columns(bins.shape[1], s, number)
        value = np.zeros(len(y))

        def grow(mask, depth):
            inner = mask & row
            value[mask] = -s.rate * g[inner].sum() / (hs[inner].sum() + s.l2)
            if depth == s.depth:
                return
            best = (max(s.least, 1e-12), None)
            for f in columns:
                for b in range(s.bins - 1):
                    left, right = inner & (bins[:, f] <= b), inner & (bins[:, f] > b)
                    if hs[left].sum() >= s.child and hs[right].sum() >= s.child:
                        gain = (g[left].sum() ** 2 / (hs[left].sum() + s.l2) + g[right].sum() ** 2 / (hs[right].sum() + s.l2) - g[inner].sum() ** 2 / (hs[inner].sum() + s.l2)) / 2
                        if gain > best[0] + 1e-11:
                            best = (gain, (f, b))
            if best[1]:
                f, b = best[1]
                grow(mask & (bins[:, f] <= b), depth + 1)
                grow(mask & (bins[:, f] > b), depth + 1)

        grow(np.ones(len(y), bool), 0)
        margin += value
        trees.append(value)
    return margin


def test_boosting_is_the_plain_version(spark):
    import pyarrow as pa

    rng = np.random.default_rng(8)
    x = rng.standard_normal((240, 4))
    x[:, 3] = np.round(x[:, 3])
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 3] + 0.3 * rng.standard_normal(240) > 0.4).astype(float)
    rows = [(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y))] + [(999, 0.0, 0.0, 0.0, 0.0, None)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int").repartition(20)
    s = Settings(rounds=12, depth=3, rate=0.3, child=2.0, positive=1.5, bins=8)
    model = boosting.fit(df, list("abcd"), "y", ["id"], s)
    hashes = {r.id: r.h for r in df.selectExpr("id", "xxhash64(id) AS h").collect()}
    bins = model.binned([pa.array(x[:, i]) for i in range(4)])
    want = plain_fit(model, bins, y, np.array([hashes[i] for i in range(240)], np.int64), s)
    got = {r.id: r.score for r in model.score(df).collect()}
    assert len(got) == 241 and len(model.trees) == 12
    assert np.abs(np.array([got[i] for i in range(240)]) - 1 / (1 + np.exp(-want))).max() < 1e-9
    assert sum(model.importance()) > 12 and np.mean([(got[i] > 0.5) == (y[i] == 1) for i in range(240)]) > 0.85


def test_boosting_without_a_split(spark):
    df = spark.createDataFrame([(i, 1.0, 1) for i in range(5)], "id long, a double, y int")
    model = boosting.fit(df, ["a"], "y", ["id"], Settings(rounds=2, rows=1.0, columns=1.0))
    assert all((t.feature < 0).all() for t in model.trees) and all(r.score > 0.5 for r in model.score(df).collect())
    assert boosting.fit(df.limit(0), ["a"], "y", ["id"], Settings(rounds=1)).score(df).first().score == 0.5
