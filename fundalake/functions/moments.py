"""Sample moments and correlation as aggregate columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skew(x: str) -> Column:
    """Sample skewness; null under 3 values."""
    n = F.count(x)
    return F.when(n >= 3, F.sqrt((n * (n - 1)).cast("double")) / (n - 2) * F.skewness(x))


def kurt(x: str) -> Column:
    """Sample excess kurtosis; null under 4 values."""
    n = F.count(x).cast("double")
    return F.when(n >= 4, F.try_divide(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(x) + 6))


def corr(x: str, y: str) -> Column:
    """Pearson's r over the rows with both; null if one of them does not vary (there the built-in divides by zero)."""
    a, b = F.col(x), F.col(y)
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)
