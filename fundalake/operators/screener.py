"""Screening: predicates, presets, rankings, profiles and trends."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.operators.ranks import beside, quantiles


@dataclass(frozen=True)
class Condition:
    """One of 11 predicates on a column.  Null is not less or greater than anything, but it is != any value and not in any list."""

    column: str
    op: str
    value: object = None
    value2: object = None

    def to_column(self) -> Column:
        c, v = F.col(self.column), self.value
        match self.op:
            case "<":
                out = c < v
            case "<=":
                out = c <= v
            case ">":
                out = c > v
            case ">=":
                out = c >= v
            case "==":
                out = c == v
            case "!=":
                return ~c.eqNullSafe(F.lit(v))
            case "between":
                out = c.between(v, self.value2)
            case "in":
                out = c.isin(*v)
            case "not_in":
                return ~F.coalesce(c.isin(*v), F.lit(False))
            case "is_null":
                return c.isNull()
            case "not_null":
                return c.isNotNull()
            case _:
                raise ValueError(self.op)
        return F.coalesce(out, F.lit(False))


C = Condition
#: The conditions of the ten presets.
PRESETS: dict[str, list[Condition]] = {
    "value_stocks": [C("pe_ratio", "between", 0, 15), C("price_to_book", "<", 1.5), C("dividend_yield", ">", 0.02)],
    "growth_stocks": [C("revenue_growth", ">", 0.15), C("net_income_growth", ">", 0.10), C("roe", ">", 0.15)],
    "quality_stocks": [C("roe", ">", 0.15), C("debt_to_equity", "<", 1.0), C("current_ratio", ">", 1.5), C("operating_margin", ">", 0.10)],
    "dividend_stocks": [C("dividend_yield", ">", 0.03), C("payout_ratio", "between", 0.2, 0.7), C("debt_to_equity", "<", 1.5)],
    "low_debt": [C("debt_ratio", "<", 0.3), C("debt_to_equity", "<", 0.5)],
    "high_profitability": [C("roe", ">", 0.20), C("roa", ">", 0.10), C("operating_margin", ">", 0.15)],
    "undervalued": [C("pe_ratio", "<", 12), C("price_to_book", "<", 1.0), C("price_to_sales", "<", 1.0)],
    "small_cap_growth": [C("close", "<", 20), C("revenue_growth", ">", 0.20)],
    "cash_rich": [C("current_ratio", ">", 2.0), C("quick_ratio", ">", 1.5), C("ocf_ratio", ">", 0.10)],
    "turnaround": [C("net_income_growth", ">", 0.50), C("revenue_growth", ">", 0.10), C("pe_ratio", "between", 5, 20)],
}
#: The columns shown.
DISPLAY = ["ticker", "date", "sector", "close", "pe_ratio", "price_to_book", "roe", "roa", "debt_to_equity", "current_ratio", "dividend_yield", "revenue_growth", "net_income_growth"]


def at_date(df: DataFrame, date: str | None = "latest") -> DataFrame:
    """Rows of each ticker's latest date (ties stay), of one date, or all."""
    if date is None:
        return df
    if date == "latest":
        return df.withColumn("_last", F.max("date").over(W.partitionBy("ticker"))).filter("date = _last").drop("_last")
    return df.filter(F.col("date") == F.to_date(F.lit(date)))


def scan(df: DataFrame, filters: Sequence[Condition] = (), preset: str | None = None, sort_by: str | None = None, ascending: bool = True, limit: int | None = None, columns: Sequence[str] | None = None, date: str | None = "latest", sector: str | None = None, country: str | None = None) -> DataFrame:
    """Rows that meet all conditions, sorted (nulls last, then by ticker) and cut; conditions on unknown columns are skipped."""
    out = at_date(df, date)
    if country:
        out = out.filter(F.col("country") == country)
    if sector:
        out = out.filter(F.col("sector") == sector)
    for c in [*(PRESETS[preset] if preset else []), *filters]:
        if c.column in df.columns:
            out = out.filter(c.to_column())
    if sort_by and sort_by in df.columns:
        key = F.col(sort_by)
        out = out.orderBy(key.asc_nulls_last() if ascending else key.desc_nulls_last(), "ticker", "date")
    if limit is not None:
        out = out.limit(limit)
    return out.select(*[c for c in (columns or DISPLAY) if c in df.columns])


def scan_indicator(df: DataFrame, indicator: str, min_value: float | None = None, max_value: float | None = None, percentiles: tuple[float, float] | None = None, top: int | None = None, bottom: int | None = None, date: str | None = "latest") -> DataFrame:
    """Screen by one column; the percentile band is that of all rows, before the date is chosen; 50 rows unless told otherwise."""
    if indicator not in df.columns:
        raise ValueError(f"no column {indicator}")
    filters = []
    if min_value is not None:
        filters.append(Condition(indicator, ">=", min_value))
    if max_value is not None:
        filters.append(Condition(indicator, "<=", max_value))
    if percentiles:
        low, high = quantiles(df, [], indicator, [p / 100 for p in percentiles]).first()[0]
        filters.append(Condition(indicator, "between", low, high))
    return scan(df, filters, sort_by=indicator, ascending=not top, limit=top or bottom or 50, date=date)


def compare(df: DataFrame, tickers: Sequence[str], indicators: Sequence[str], date: str | None = "latest") -> DataFrame:
    return at_date(df.filter(F.col("ticker").isin(*tickers)), date).select("ticker", "date", *indicators)


def sector_ranking(df: DataFrame, indicator: str, how: str = "mean", min_companies: int = 5, date: str | None = "latest") -> DataFrame:
    """Sectors by the mean, median, max or min of a column."""
    rows = at_date(df, date).filter("sector is not null")
    if how == "median":
        rows = beside(rows, quantiles(rows, ["sector"], indicator, [0.5], "_median"), ["sector"])
    value = F.first("_median")[0] if how == "median" else {"mean": F.avg, "max": F.max, "min": F.min}[how](indicator)
    g = rows.groupBy("sector").agg(F.round(value, 4).alias("value"), F.count(indicator).alias("observations"), F.round(F.stddev_samp(indicator), 4).alias("std"), F.countDistinct("ticker").alias("n_companies"))
    return g.filter(F.col("n_companies") >= min_companies).orderBy(F.col("value").desc_nulls_last(), "sector")


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(W.partitionBy("ticker").orderBy(F.col("date").desc())))


def _last_values(column: str, periods: int) -> Column:
    """The non-null values among the last rows of a group that _numbered() has numbered, the latest first; at most ``periods``."""
    rows = F.sort_array(F.collect_list(F.when((F.col("_r") <= periods) & F.col(column).isNotNull(), F.struct("_r", F.col(column).cast("double").alias("x")))))
    return F.transform(rows, lambda r: r["x"])


def _direction(values: Column) -> Column:
    """rising, falling or stable, of values that begin with the latest."""
    n = F.size(values)
    half = F.floor(n / 2).cast("int")
    mean = lambda side: F.try_divide(F.aggregate(side, F.lit(0.0), lambda a, x: a + x), half.cast("double"))
    early, late = mean(F.slice(values, n - half + 1, half)), mean(F.slice(values, 1, half))
    change = F.when(early == 0, 0.0).otherwise((late - early) / F.abs(early))
    return F.when(n >= 2, F.when(change > 0.05, "rising").when(change < -0.05, "falling").otherwise("stable"))


def trend(df: DataFrame, column: str, periods: int = 12) -> DataFrame:
    """(ticker, <column>_trend) over each ticker's last rows.

    The mean of the first half of the non-null values against the second (the
    middle of an odd number is in neither): over 5 % up is rising, down is
    falling, else stable; a first mean of 0 is stable; under two values: null.
    """
    g = _numbered(df.select("ticker", "date", column)).groupBy("ticker").agg(_last_values(column, periods).alias("_v"))
    return g.select("ticker", _direction(F.col("_v")).alias(f"{column}_trend"))


PROFILE = {"close": 2, "pe_ratio": 2, "price_to_book": 2, "roe": 4, "roa": 4, "debt_to_equity": 2, "current_ratio": 2, "dividend_yield": 4, "revenue_growth": 4, "net_income_growth": 4}


def profiles(df: DataFrame, periods: int = 12) -> DataFrame:
    """A row per ticker: latest values, trends of price, earnings multiple and return on equity, and the range of the data; one shuffle."""
    fields, trends = ["sector", "industry", *PROFILE], ("close", "pe_ratio", "roe")
    ends = [F.max_by(F.struct(*fields), "date").alias("m"), F.count("*").alias("data_points"), F.min("date").alias("first_date"), F.max("date").alias("latest_date")]
    g = _numbered(df.select("ticker", "date", *fields)).groupBy("ticker").agg(*ends, *[_last_values(c, periods).alias(f"_{c}") for c in trends])
    return g.select("ticker", "m.sector", "m.industry", "latest_date", *[F.round(F.col(f"m.{c}"), n).alias(c) for c, n in PROFILE.items()], "data_points", "first_date", *[_direction(F.col(f"_{c}")).alias(f"{c}_trend") for c in trends])
