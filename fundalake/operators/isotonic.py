"""Isotonic regression by pools that merge.

Rows are summed by score.  The scores are ranked in two levels and dealt into
slots of equal size; in each slot neighbours whose means fall are pooled.  Pools
of neighbouring slots are then merged in levels, ``FAN`` slots in a task: pooling
what is pooled already gives the same fit as pooling all at once, as a pool is
decided by the sums of its rows alone.  What goes up is a row for each different
fitted value, so nothing holds the scores together.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.operators.asof import asof_join
from fundalake.operators.ranks import running
from fundalake.sources.staging import materialized

FAN = 16
#: Different scores of a slot.
SLOT_SCORES = 1 << 16
_POOL = "slot long, lo double, hi double, w double, wy double"


def pooled(lo: list[float], hi: list[float], w: list[float], wy: list[float]) -> list[list[float]]:
    """Neighbouring pools, in the order of their scores, joined until the means rise."""
    out: list[list[float]] = []
    for pool in zip(lo, hi, w, wy):
        out.append(list(pool))
        # means are compared without a division
        while len(out) > 1 and out[-2][3] * out[-1][2] >= out[-1][3] * out[-2][2]:
            a, b, c, d = out.pop()
            out[-1] = [out[-1][0], b, out[-1][2] + c, out[-1][3] + d]
    return out


class Isotonic:
    """``knots``: (x, value), where the fitted line bends, in the order of x; between them it is straight, outside level."""

    def __init__(self, knots: DataFrame) -> None:
        self.knots = knots

    def apply(self, df: DataFrame, score: str, out: str) -> DataFrame:
        """``df`` with the fitted value of a score; null for null."""
        ahead = W.partitionBy("_one").orderBy("x")  # knots, of which there is one or two a fitted value
        knots = self.knots.withColumn("_one", F.lit(1))
        knots = knots.withColumns({"x1": F.lead("x").over(ahead), "v1": F.lead("value").over(ahead)})
        first = knots.agg(F.min_by("value", "x").alias("_least"))  # one row
        rows = asof_join(df.withColumn("_one", F.lit(1)), knots, ["_one"], score, "x", plan="sliced", width=1 / 256, match="_knot").join(F.broadcast(first))
        k = lambda c: F.col(f"_knot.{c}")
        straight = k("value") + (k("v1") - k("value")) * F.try_divide(F.col(score) - k("x"), k("x1") - k("x"))
        value = F.when(F.col(score).isNull(), None).when(k("x").isNull(), F.col("_least")).when(k("x1").isNull(), k("value")).otherwise(straight)
        return rows.select(*df.columns, value.alias(out))


def fit(df: DataFrame, score: str, label: str, weight: str | None = None, slot: int = SLOT_SCORES) -> Isotonic:
    """The rising line of least squares through the labels; rows with a null or NaN are left out."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y"), w.alias("w")).filter("x is not null and y is not null and w > 0 and not isnan(x)")
    sums = materialized(rows.groupBy("x").agg(F.sum("w").alias("w"), F.sum(F.col("w") * F.col("y")).alias("wy")), "isotonic-sums").withColumn("one", F.lit(1))
    ranked = running(sums, [], "x", "one")
    pools = ranked.select(F.floor(F.col("_below") / slot).alias("slot"), F.col("x").alias("lo"), F.col("x").alias("hi"), "w", "wy")
    slots = -(-(sums.count()) // slot)

    def merge(table: pa.Table, step: int) -> pa.Table:
        table = table.sort_by("lo")
        out = pooled(*(table[c].to_pylist() for c in ("lo", "hi", "w", "wy")))
        group = table["slot"][0].as_py() // step
        return pa.table([pa.array([group] * len(out), pa.int64()), *[pa.array([p[i] for p in out], pa.float64()) for i in range(4)]], names=["slot", "lo", "hi", "w", "wy"])

    pools = pools.groupBy("slot").applyInArrow(lambda t: merge(t, 1), _POOL)
    while slots > 1:
        pools = pools.groupBy(F.floor(F.col("slot") / FAN).alias("group")).applyInArrow(lambda t: merge(t, FAN), _POOL)
        slots = -(-slots // FAN)
    value = F.col("wy") / F.col("w")
    ends = F.array_distinct(F.array("lo", "hi"))
    return Isotonic(materialized(pools.select(F.explode(ends).alias("x"), value.alias("value")), "isotonic"))
