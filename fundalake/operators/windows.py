"""Windowed building blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order (row_number = 1, which Spark cuts before the shuffle)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def filled_forward(column: str, keys: Sequence[str], order: Sequence[Column]) -> Column:
    """The last non-null value up to the row."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return F.coalesce(F.col(column), F.last(column, ignorenulls=True).over(w))


def rolling_sum(column: str, keys: Sequence[str], order: Sequence[Column], rows: int) -> Column:
    """Sum over the last rows; exact decimals, so that it does not depend on the order of addition."""
    w = W.partitionBy(*keys).orderBy(*order).rowsBetween(1 - rows, 0)
    return F.sum(F.col(column).cast("decimal(28,6)")).over(w).cast("double")


def exact_sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(28,6)")).cast("double")
