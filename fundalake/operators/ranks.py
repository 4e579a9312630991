"""Ranks and exact quantiles of a column within keys: counts of the different values, summed in two levels, so that no task holds a whole key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Slots to a doubling of the value.
FINENESS = 256


def long(df: DataFrame, columns: Sequence[str], *keys: str | Column) -> DataFrame:
    """(keys, column, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    rows = df.select(*keys, F.explode(cells).alias("_c"))
    return rows.select(*[c for c in rows.columns if c != "_c"], "_c.*")


def slot(value: Column) -> Column:
    """A whole number that never falls as the value (double) grows; NaN comes last, as in Spark's order."""
    far = 2**20  # beyond every exponent of a double at this fineness
    size = F.floor(F.least(F.log2(F.abs(value)) * FINENESS, F.lit(far / 2))) + far
    return F.when(F.isnan(value), 2 * far).when(value == 0, 0).when(value < 0, -size).otherwise(size)


def beside(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``; null keys are equal."""
    named = right.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] or F.lit(True)
    return left.join(named, on, how).drop(*[f"_k_{k}" for k in keys])


def running(counts: DataFrame, keys: Sequence[str], value: str, n: str = "n") -> DataFrame:
    """``counts``, a row per key and value (double, not null), with _below, the sum of ``n`` over the key's lesser values, and _total.

    Values are dealt into slots: one window runs over the slots of a key, whose
    number is bounded, the other over the values of a slot.
    """
    rows = counts.withColumn("_slot", slot(F.col(value)))
    slots = rows.groupBy(*keys, "_slot").agg(F.sum(n).alias("_size"))
    key = W.partitionBy(*keys)
    starts = slots.select(*keys, "_slot", F.coalesce(F.sum("_size").over(key.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"), F.sum("_size").over(key).alias("_total"))
    before = W.partitionBy(*keys, "_slot").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    inside = rows.withColumn("_below", F.coalesce(F.sum(n).over(before), F.lit(0)))
    return beside(inside, starts, [*keys, "_slot"], "inner").withColumn("_below", F.col("_below") + F.col("_start")).drop("_slot", "_start")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, ps: Sequence[float], name: str = "_p") -> DataFrame:
    """(keys, ``name``): the exact quantiles ``ps`` of the non-null values, between two values by straight line.

    A key without values has no row; without keys there is one row, of nulls if there are no values.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("n"))
    at = lambda i: F.max(F.when((F.col("_below") <= i) & (i < F.col("_below") + F.col("n")), F.col("_v")))
    ends = []
    for p in ps:
        place = (F.col("_total") - 1) * F.lit(float(p))
        ends.append(F.struct(at(F.floor(place)).alias("lo"), at(F.ceil(place)).alias("hi"), F.max(place - F.floor(place)).alias("part")))
    between = lambda e: F.when(e["lo"] == e["hi"], e["lo"]).otherwise((1 - e["part"]) * e["lo"] + e["part"] * e["hi"])
    return running(counts, keys, "_v").groupBy(*keys).agg(F.array(*ends).alias("_e")).select(*keys, F.transform("_e", between).alias(name))
