"""Statistics, correlations, data quality and chart data, each as one or two aggregations over long or wide columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.functions.local import small
from fundalake.functions.moments import corr, kurt, skew
from fundalake.operators.ranks import beside, long, quantiles, running

#: The columns that are described unless others are named.
COLUMNS = (
    "pe_ratio price_to_book price_to_sales price_to_earnings roe roa ros gross_margin operating_margin debt_ratio debt_to_equity current_ratio quick_ratio "
    "asset_turnover inventory_turnover ocf_ratio capex_ratio free_cash_flow revenue_growth net_income_growth dividend_yield payout_ratio close high low "
    "gdp_yoy cpi_yoy unemp_level rate_level"
).split()
#: The groups of indicators.
GROUPS = {
    "valuation": ["pe_ratio", "price_to_book", "price_to_sales", "price_to_earnings"], "profitability": ["roe", "roa", "ros", "gross_margin", "operating_margin"],
    "leverage": ["debt_ratio", "debt_to_equity"], "liquidity": ["current_ratio", "quick_ratio"], "efficiency": ["asset_turnover", "inventory_turnover"],
    "cashflow": ["ocf_ratio", "capex_ratio", "free_cash_flow", "fcf_ttm"], "growth": ["revenue_growth", "net_income_growth"], "dividends": ["dividend_yield", "payout_ratio"],
    "macro": ["gdp_yoy", "cpi_yoy", "unemp_level", "rate_level"],
}
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
QUARTILES = (0.25, 0.5, 0.75)


def describe(df: DataFrame, columns: Sequence[str] = COLUMNS, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """A row per column: count, moments, percentiles, missing, zeros, negatives, interquartile range."""
    cells = long(df, [c for c in columns if c in df.columns])
    g = cells.groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("missing"), (100 * F.count_if(F.col("value").isNull()) / F.count("*")).alias("missing_pct"), F.count_if(F.col("value") == 0).alias("zeros"), F.count_if(F.col("value") < 0).alias("negatives"),
        skew("value").alias("skewness"), kurt("value").alias("kurtosis"),
    )
    out = beside(g, quantiles(cells, ["column"], "value", [*percentiles, 0.25, 0.75]), ["column"])
    k = len(percentiles)
    return out.withColumns({f"p{round(100 * p)}": F.col("_p")[i] for i, p in enumerate(percentiles)} | {"iqr": F.col("_p")[k + 1] - F.col("_p")[k]}).drop("_p")


def describe_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """Statistics of a column per group, the null group included, the largest group first."""
    g = df.groupBy(group).agg(F.count(column).alias("count"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"), F.min(column).alias("min"), F.max(column).alias("max"), skew(column).alias("skewness"))
    g = beside(g, quantiles(df, [group], column, QUARTILES, "_q"), [group])
    out = g.select(group, "count", *[F.round(x, 4).alias(n) for n, x in (("mean", F.col("mean")), ("std", F.col("std")), ("min", F.col("min")), ("q25", F.col("_q")[0]), ("median", F.col("_q")[1]), ("q75", F.col("_q")[2]), ("max", F.col("max")), ("skewness", F.col("skewness")))])
    return out.orderBy(F.col("count").desc(), F.col(group).asc_nulls_last())


def missing_report(df: DataFrame, threshold_pct: float = 0.0) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).isNull().alias("gone")) for c in df.columns])
    g = df.select(F.explode(cells).alias("c")).groupBy("c.column").agg(F.count_if("c.gone").alias("missing_count"), F.round(100 * F.count_if("c.gone") / F.count("*"), 2).alias("missing_pct"), F.count_if(~F.col("c.gone")).alias("present_count"))
    return g.filter(F.col("missing_pct") >= threshold_pct).orderBy(F.col("missing_pct").desc(), "column")


def quality_summary(df: DataFrame) -> DataFrame:
    n = len(df.columns)
    gone = sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0))
    g = df.agg(F.count("*").alias("total_rows"), F.lit(n).alias("total_columns"), gone.alias("missing_cells"), F.countDistinct("ticker").alias("unique_tickers"), F.countDistinct("sector").alias("unique_sectors"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    g = g.withColumn("total_cells", F.col("total_rows") * n).withColumn("missing_pct", F.round(100 * F.try_divide(F.col("missing_cells"), F.col("total_cells")), 2))
    return g.withColumn("completeness_pct", F.round(100 - 100 * F.try_divide(F.col("missing_cells"), F.col("total_cells")), 2))


def outliers(df: DataFrame, columns: Sequence[str] = COLUMNS, method: str = "iqr", threshold: float = 1.5, digits: int = 4) -> DataFrame:
    """Values outside the fences, or more than ``threshold`` population standard deviations from the mean; a row per column with values."""
    cells = long(df, [c for c in columns if c in df.columns]).filter("value is not null")
    if method == "iqr":
        span = quantiles(cells, ["column"], "value", (0.25, 0.75), "q").select("column", (F.col("q")[0] - threshold * (F.col("q")[1] - F.col("q")[0])).alias("low"), (F.col("q")[1] + threshold * (F.col("q")[1] - F.col("q")[0])).alias("high"))
        out = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
        bounds = [F.round(F.first("low"), digits).alias("lower_bound"), F.round(F.first("high"), digits).alias("upper_bound")]
    elif method == "zscore":
        span = cells.groupBy("column").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
        out = F.coalesce(F.abs(F.try_divide(F.col("value") - F.col("m"), F.col("s"))) > threshold, F.lit(False))
        bounds = [F.lit(None).cast("double").alias("lower_bound"), F.lit(None).cast("double").alias("upper_bound")]
    else:
        raise ValueError(method)
    g = cells.join(F.broadcast(span), "column").groupBy("column").agg(F.count("*").alias("total_values"), F.count_if(out).alias("outliers_count"), *bounds)  # a row per column
    return g.withColumn("outliers_pct", F.round(100 * F.col("outliers_count") / F.col("total_values"), 2))


def _concordance(cells: DataFrame) -> DataFrame:
    """(a, b, s) from (a, b, x, y, n): concordant less discordant pairs.

    x and y become their ranks among the different values, written in 16-digits.
    Two rows part at one digit of x and at one of y, the highest that differ, so
    each pair is counted in one block of (digit's place, digits above) of x and
    of y.  A block is at most 16 rows of 16 counts; a row makes as many entries
    as the digits of x times those of y, which are aggregated before the shuffle.
    """
    for c in ("x", "y"):
        ranks = running(cells.select("a", "b", c).distinct().withColumn("one", F.lit(1)), ["a", "b"], c, "one")
        places = F.expr("sequence(0, length(hex(_total - 1)) - 1)")
        cells = cells.join(ranks.select("a", "b", c, F.col("_below").alias(f"r{c}"), places.alias(f"p{c}")), ["a", "b", c])
    dealt = cells.select("a", "b", "n", "rx", "ry", "py", F.explode("px").alias("px")).select("a", "b", "n", "rx", "ry", "px", F.explode("py").alias("py"))
    block = ["a", "b", "px", "hx", "py", "hy"]
    for c in ("x", "y"):
        dealt = dealt.withColumn(f"h{c}", F.expr(f"shiftright(r{c}, 4 * (p{c} + 1))")).withColumn(f"d{c}", F.expr(f"shiftright(r{c}, 4 * p{c}) & 15"))
    rows = dealt.groupBy(*block, "dx").agg(*[F.sum(F.when(F.col("dy") == j, F.col("n")).otherwise(0)).cast("double").alias(f"c{j}") for j in range(16)])
    before = W.partitionBy(*block).orderBy("dx").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.select("a", "b", *[f"c{j}" for j in range(16)], *[F.coalesce(F.sum(f"c{j}").over(before), F.lit(0.0)).alias(f"q{j}") for j in range(16)])
    signed = [F.col(f"c{j}") * (sum((F.col(f"q{i}") for i in range(j)), F.lit(0.0)) - sum((F.col(f"q{i}") for i in range(j + 1, 16)), F.lit(0.0))) for j in range(16)]
    return rows.groupBy("a", "b").agg(F.sum(sum(signed, F.lit(0.0))).alias("s"))


def _pairs(columns: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(columns, 2))


#: What is summed of each pair of columns, over the rows that have both: rows, sums, squares, products; then the bounds of each.
_MOMENTS = ("n", "x", "y", "xx", "yy", "xy")
_BOUNDS = ("x_low", "x_high", "y_low", "y_high")


def _moments(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A row for each pair (i, j) of columns with the moments of a task's rows, by products of blocks of rows with their masks."""
    k = len(shift)
    i, j = np.triu_indices(k, 1)
    sums = {c: np.zeros((k, k)) for c in ("n", "x", "xx", "xy")}
    low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
    for batch in batches:
        v = np.column_stack([np.asarray(c.fill_null(np.nan).to_numpy(zero_copy_only=False), float) for c in batch.columns]) - shift
        have = np.isfinite(v)
        m, x = have.astype(float), np.where(have, v, 0.0)
        sums["n"] += m.T @ m
        sums["x"] += x.T @ m
        sums["xx"] += (x * x).T @ m
        sums["xy"] += x.T @ x
        for c in range(k):  # the bounds of every column over the rows that have column c
            rows = have[:, c]
            if rows.any():
                low[:, c] = np.minimum(low[:, c], np.where(have[rows], v[rows], np.inf).min(axis=0))
                high[:, c] = np.maximum(high[:, c], np.where(have[rows], v[rows], -np.inf).max(axis=0))
    s = sums
    values = [s["n"][i, j], s["x"][i, j], s["x"][j, i], s["xx"][i, j], s["xx"][j, i], s["xy"][i, j], low[i, j], high[i, j], low[j, i], high[j, i]]
    yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(c) for c in values]], names=["i", "j", *_MOMENTS, *_BOUNDS])


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, correlation) of all pairs of columns, from one pass over the rows.

    Each task adds up the moments of all pairs and gives one row a pair; these
    are summed.  Values are taken from their column's mean first.  Non-finite
    values count as missing.  A pair without common rows has n = 0; null where
    a column does not vary over the common rows.
    """
    pairs = _pairs(columns)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    finite = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c))
    shift = np.array([v or 0.0 for v in rows.agg(*[F.avg(finite(c)).alias(c) for c in rows.columns]).first()] if columns else [])
    kind = "i int, j int, " + ", ".join(f"{c} double" for c in (*_MOMENTS, *_BOUNDS))
    parts = rows.mapInArrow(lambda it: _moments(it, shift), kind)
    g = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in _MOMENTS], *[(F.min if c.endswith("low") else F.max)(c).alias(c) for c in _BOUNDS])
    c = F.col
    spread = (c("n") * c("xx") - c("x") * c("x")) * (c("n") * c("yy") - c("y") * c("y"))
    varies = (c("n") > 1) & (c("x_low") < c("x_high")) & (c("y_low") < c("y_high")) & (spread > 0)
    r = F.when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (c("n") * c("xy") - c("x") * c("y")) / F.sqrt(spread))))
    named = small(df.sparkSession, [(columns.index(a), columns.index(b), a, b) for a, b in pairs], pa.schema({"i": pa.int32(), "j": pa.int32(), "a": pa.string(), "b": pa.string()}))
    return named.join(g, ["i", "j"], "left").select("a", "b", F.coalesce(c("n"), F.lit(0.0)).cast("long").alias("n"), r.alias("correlation"))


def correlations(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """(a, b, correlation) of each pair of columns over the rows that have both; null for pairs without such rows.

    Pearson's is one pass, see ``pearson``; the ranks of the others differ from
    pair to pair, so they make a row a pair of each row.  Kendall's tau-b is
    exact and forms no pairs of rows, see ``_concordance``.
    """
    if method == "pearson":
        return pearson(df, list(columns)).drop("n")
    pairs = _pairs(columns)
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for a, b in pairs])
    rows = df.select(F.explode(cells).alias("_p")).select("_p.*").filter("x is not null and y is not null")
    return small(df.sparkSession, pairs, pa.schema({"a": pa.string(), "b": pa.string()})).join(_ranked(rows, method), ["a", "b"], "left")


def _ranked(rows: DataFrame, method: str) -> DataFrame:
    """Spearman's or Kendall's correlation of (a, b, x, y)."""
    if method == "spearman":
        ranked = rows
        for c in ("x", "y"):
            ranks = running(rows.groupBy("a", "b", c).agg(F.count("*").alias("n")), ["a", "b"], c)
            ranked = ranked.join(ranks.select("a", "b", c, (F.col("_below") + (F.col("n") + 1) / 2).alias(f"r{c}")), ["a", "b", c])
        return ranked.groupBy("a", "b").agg(corr("rx", "ry").alias("correlation"))
    if method == "kendall":
        cells = rows.groupBy("a", "b", "x", "y").agg(F.count("*").alias("n"))
        pairs_of = lambda n: n * (n - 1) / 2
        ties = lambda c: cells.groupBy("a", "b", c).agg(F.sum("n").alias("n")).groupBy("a", "b").agg(F.sum(pairs_of(F.col("n"))).alias(f"t{c}"), F.sum("n").alias(f"n{c}"))
        g = ties("x").join(ties("y"), ["a", "b"]).join(_concordance(cells), ["a", "b"], "left")
        total = pairs_of(F.col("nx"))
        return g.select("a", "b", F.try_divide(F.coalesce("s", F.lit(0.0)), F.sqrt((total - F.col("tx")) * (total - F.col("ty")))).alias("correlation"))
    raise ValueError(method)


def correlation_with(df: DataFrame, target: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """Pearson correlation of each column with the target, the strongest first."""
    names = [c for c in columns if c in df.columns and c != target]
    g = pearson(df, [target, *names]).filter(F.col("a") == target)
    g = g.select(F.col("b").alias("variable"), "correlation", F.abs("correlation").alias("abs_correlation"))
    return g.orderBy(F.col("abs_correlation").desc_nulls_last(), "variable")


def high_correlations(df: DataFrame, columns: Sequence[str] = COLUMNS, threshold: float = 0.8) -> DataFrame:
    return correlations(df, columns).filter(F.abs("correlation") >= threshold).orderBy(F.abs("correlation").desc(), "a", "b")


def correlation_by_sector(df: DataFrame, a: str, b: str, min_samples: int = 10) -> DataFrame:
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & F.col("sector").isNotNull())
    g = both.groupBy("sector").agg(corr(a, b).alias("correlation"), F.count("*").alias("n_samples"))
    return g.filter(F.col("n_samples") >= min_samples).orderBy(F.col("correlation").desc_nulls_last(), "sector")


# chart data


def clipped(df: DataFrame, column: str, low: float = 1, high: float = 99, *keys: str) -> DataFrame:
    """Non-null values between two percentiles, with the keys."""
    have = df.filter(F.col(column).isNotNull()).select(*keys, F.col(column).cast("double").alias("value"))
    band = quantiles(have, [], "value", (low / 100, high / 100))
    return have.join(F.broadcast(band)).filter((F.col("value") >= F.col("_p")[0]) & (F.col("value") <= F.col("_p")[1])).drop("_p")  # one row


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, n) of equal bins between the clipped least and greatest value; the last bin is closed."""
    rows = clipped(df, column)
    span = rows.agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    at = F.least(F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    return rows.join(F.broadcast(span)).groupBy(F.coalesce(at, F.lit(0)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def box(df: DataFrame, column: str, *keys: str) -> DataFrame:
    """Quartiles, mean, and the ends of the whiskers."""
    rows = clipped(df, column, 1, 99, *keys)
    q = beside(rows.groupBy(*keys).agg(F.avg("value").alias("mean"), F.count("*").alias("n")), quantiles(rows, keys, "value", QUARTILES, "q"), keys)
    fence = lambda s: F.col("q")[1 + s] + s * 1.5 * (F.col("q")[2] - F.col("q")[0])
    both = rows.join(q, list(keys)) if keys else rows.join(F.broadcast(q))  # one row
    inside = F.when(F.col("value").between(fence(-1), fence(1)), F.col("value"))
    return both.groupBy(*keys).agg(F.first("n").alias("n"), F.first("mean").alias("mean"), *[F.first(F.col("q")[i]).alias(c) for i, c in enumerate(("q25", "median", "q75"))], F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"))


def box_by_sector(df: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Boxes of the sectors with the most rows, the highest median first."""
    largest = df.filter("sector is not null").groupBy("sector").agg(F.count("*").alias("_n")).orderBy(F.col("_n").desc(), "sector").limit(top)
    return box(df.join(F.broadcast(largest), "sector"), column, "sector").orderBy(F.col("median").desc(), "sector")


def clipped_long(df: DataFrame, columns: Sequence[str], low: float = 1, high: float = 99) -> DataFrame:
    """(column, value): non-null values between two percentiles of their column."""
    cells = long(df, [c for c in columns if c in df.columns]).filter("value is not null")
    band = quantiles(cells, ["column"], "value", (low / 100, high / 100))
    return cells.join(band, "column").filter((F.col("value") >= F.col("_p")[0]) & (F.col("value") <= F.col("_p")[1])).drop("_p")


def histogram_grid(df: DataFrame, columns: Sequence[str] = COLUMNS, bins: int = 50, most: int = 12) -> DataFrame:
    """(column, bin, n): the histograms of the first ``most`` of the columns that are there."""
    rows = clipped_long(df, [c for c in columns if c in df.columns][:most])
    both = rows.join(rows.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi")), "column")
    at = F.least(F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    return both.groupBy("column", F.coalesce(at, F.lit(0)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def violin(df: DataFrame, columns: Sequence[str] = ("roe", "roa", "ros", "gross_margin", "operating_margin")) -> DataFrame:
    """(column, n, mean, std, q25, median, q75) of the clipped values: the lines inside violins, and the text beside histograms."""
    rows = clipped_long(df, columns)
    g = rows.groupBy("column").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    out = beside(g, quantiles(rows, ["column"], "value", QUARTILES, "q"), ["column"])
    return out.select("column", "n", "mean", "std", *[F.col("q")[i].alias(c) for i, c in enumerate(("q25", "median", "q75"))])


def price_history(df: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """(ticker, date, close) of some tickers, in the order of drawing."""
    return df.filter(F.col("ticker").isin(*tickers)).select("ticker", "date", "close").orderBy("ticker", "date")


def group_columns(df: DataFrame, group: str = "all") -> list[str]:
    """The columns of a group of indicators, or of all groups, that ``df`` has."""
    if group != "all" and group not in GROUPS:
        raise ValueError(f"no group {group}")
    names = GROUPS[group] if group != "all" else dict.fromkeys(c for g in GROUPS.values() for c in g)
    return [c for c in names if c in df.columns]


def heatmap(df: DataFrame, columns: Sequence[str], method: str = "pearson") -> DataFrame:
    """(a, b, correlation, masked): the square matrix in long form; masked above the diagonal."""
    half = correlations(df, columns, method)
    ones = df.agg(*[F.when(F.stddev_pop(c) > 0, 1.0).alias(c) for c in columns])
    same = long(ones, columns).select(F.col("column").alias("a"), F.col("column").alias("b"), F.col("value").alias("correlation"), F.lit(False).alias("masked"))
    above = half.select("a", "b", "correlation", F.lit(True).alias("masked"))
    below = half.select(F.col("b").alias("a"), F.col("a").alias("b"), "correlation", F.lit(False).alias("masked"))
    return same.unionByName(above).unionByName(below)


def scaled_series(df: DataFrame, tickers: Sequence[str], column: str, scale: bool = True) -> DataFrame:
    """(ticker, date, value), brought to 0..1 per ticker."""
    w = W.partitionBy("ticker")
    x = F.col(column)
    value = F.try_divide(x - F.min(x).over(w), F.max(x).over(w) - F.min(x).over(w)) if scale else x
    return df.filter(F.col("ticker").isin(*tickers) & x.isNotNull()).select("ticker", "date", value.alias("value"))


def sector_composition(df: DataFrame, top: int = 15) -> DataFrame:
    return df.filter("sector is not null").groupBy("sector").agg(F.countDistinct("ticker").alias("n_tickers")).orderBy(F.col("n_tickers").desc(), "sector").limit(top)


def missing_bands(df: DataFrame, top: int = 30) -> DataFrame:
    band = F.when(F.col("missing_pct") > 50, "high").when(F.col("missing_pct") > 20, "medium").otherwise("low")
    return missing_report(df).select("column", "missing_pct", band.alias("band")).orderBy(F.col("missing_pct").desc(), "column").limit(top)


def scatter_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line and r over all rows with both."""
    have = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    return have.agg(F.count("*").alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), corr(x, y).alias("r"))


def scatter_points(df: DataFrame, x: str, y: str, hue: str = "sector", limit: int = 5000, top: int = 10) -> DataFrame:
    """A fixed sample of the points for drawing, the smaller groups named Other."""
    largest = df.filter(F.col(hue).isNotNull()).groupBy(hue).agg(F.count("*").alias("_n")).orderBy(F.col("_n").desc(), hue).limit(top).select(F.col(hue).alias("_top"))
    pts = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).orderBy(F.md5(F.concat_ws("|", "ticker", "date")), "ticker", "date").limit(limit)
    return pts.join(F.broadcast(largest), F.col(hue) == F.col("_top"), "left").select("ticker", "date", x, y, F.when(F.col("_top").isNotNull(), F.col(hue)).otherwise("Other").alias("hue"))
