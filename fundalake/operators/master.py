"""The monthly point-in-time table: what was known of each company at the start of each month."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.operators.asof import asof_join
from fundalake.operators.windows import dedup_by, exact_sum, rolling_sum
from fundalake.plans.constants import CONCEPTS, MACRO

STALE_DAYS = 150
MAX_GAP_DAYS = 31
KEY = ["ticker", "country"]


def publication_date(day: Column) -> Column:
    """First of the month after the day after."""
    return F.add_months(F.trunc(F.date_add(day, 1), "MM"), 1)


def published(wide: DataFrame, as_of: datetime.date, max_gap_days: int = MAX_GAP_DAYS) -> DataFrame:
    """Rows with a plausible date and a filing at most ``max_gap_days`` before its publication month.

    31 days drop filings on the last of a month before one of 31 days; that is kept as it is.
    """
    last = F.add_months(F.lit(as_of), 12)
    out = wide.withColumn("publication_date", publication_date(F.coalesce("filing_date", "end_date")))
    plausible = lambda c: F.col(c).isNull() | (F.col(c) <= last)
    near = F.col("filing_date").isNull() | (F.datediff(publication_date(F.col("filing_date")), "filing_date") <= max_gap_days)
    return out.filter(plausible("filing_date") & plausible("end_date") & near)


def first_reports(rows: DataFrame) -> DataFrame:
    """Per publication month the report with the oldest end date."""
    return dedup_by(rows, [*KEY, "publication_date"], [F.col("end_date").asc_nulls_last(), F.col("fiscal_quarter").asc_nulls_last()])


def monthly_spine(rows: DataFrame) -> DataFrame:
    """A row per month from the first to the last publication of each company."""
    span = rows.groupBy(*KEY).agg(F.min("publication_date").alias("a"), F.max("publication_date").alias("b"))
    return span.select(*KEY, F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("date"))


def with_reports(spine: DataFrame, rows: DataFrame, stale_days: int | None = STALE_DAYS) -> DataFrame:
    """The latest report of each month; blank, not an older one, once it is over ``stale_days`` old."""
    carried = ["end_date", "filing_date", "fiscal_quarter", *CONCEPTS]
    out = asof_join(spine, rows.select(*KEY, "publication_date", *carried), KEY, "date", "publication_date")
    report = F.col("_match")
    if stale_days is not None:
        report = F.when(F.datediff("date", F.col("_match.publication_date")) <= stale_days, report)
    return out.withColumn("_match", report).select("ticker", "date", "country", *[F.col(f"_match.{c}").alias(c) for c in carried])


def with_prices_sectors(rows: DataFrame, prices: DataFrame, sectors: DataFrame, price_join: str = "month_start") -> DataFrame:
    """Prices of the month's first day (or of the last session in the month before) and sectors."""
    p = prices.select(*KEY, "date", "high", "low", "close")
    if price_join == "month_last":
        p = dedup_by(p.withColumn("_m", F.add_months(F.trunc("date", "MM"), 1)), [*KEY, "_m"], [F.col("date").desc()]).withColumn("date", F.col("_m")).drop("_m")
    out = rows.join(p, [*KEY, "date"], "left")
    return out.join(sectors.select(*KEY, "sector", "industry"), KEY, "left")


def with_shares(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """The share count of the last quarter end (ties: the latest filing)."""
    out = asof_join(rows, shares.select(*KEY, "end_date", "filing_date", "shares").withColumnsRenamed({"end_date": "_at_end"}), KEY, "date", "_at_end", tie=[F.col("filing_date").desc_nulls_last(), F.col("shares").desc_nulls_last()])
    return out.select(*rows.columns, F.col("_match.shares").alias("shares_outstanding"))


def monthly_dividends(dividends: DataFrame) -> DataFrame:
    return dividends.groupBy(*KEY, F.trunc("dividend_date", "MM").alias("month_start")).agg(exact_sum("dividend_amount").alias("dividend_amount"))


def with_dividends(rows: DataFrame, dividends: DataFrame) -> DataFrame:
    return rows.join(monthly_dividends(dividends).withColumnRenamed("month_start", "date"), [*KEY, "date"], "left")


def with_macro(rows: DataFrame, macro: DataFrame) -> DataFrame:
    """The latest published macro figures of the country; by slices of time, as a country may hold most of the rows."""
    out = asof_join(rows, macro.select("country", "publication_date", *MACRO), ["country"], "date", "publication_date", plan="sliced")
    return out.select(*rows.columns, *[F.col(f"_match.{c}").alias(c) for c in MACRO])


def _over(a: str, b: str, *more: str) -> Column:
    """a / b where b, and what else is named, is positive."""
    guard = F.col(b) > 0
    for c in more:
        guard &= F.col(c) > 0
    return F.when(guard, F.col(a) / F.col(b))


RATIOS = (
    "revenue_per_share operating_income_per_share assets_per_share rnd_per_share sga_per_share net_income_per_share roe roa ros gross_margin operating_margin "
    "debt_ratio debt_to_equity free_cash_flow ocf_ratio capex_ratio current_ratio quick_ratio price_to_book price_to_sales price_to_earnings pe_ratio "
    "dividend_yield payout_ratio asset_turnover inventory_turnover"
).split()


def ratio_columns() -> dict[str, Column]:
    """The 26 ratios."""
    c = F.col
    cap = c("close") * c("shares_outstanding")
    traded = (c("close") > 0) & (c("shares_outstanding") > 0)
    valued = lambda by: F.when(traded & (c(by) > 0), cap / c(by))
    share = lambda x: _over(x, "shares_outstanding")
    return {
        "revenue_per_share": share("Revenues"), "operating_income_per_share": share("OperatingIncomeLoss"), "assets_per_share": share("Assets"),
        "rnd_per_share": share("ResearchAndDevelopment"), "sga_per_share": share("GeneralAndAdministrativeExpense"), "net_income_per_share": share("NetIncomeLoss"),
        "roe": _over("NetIncomeLoss", "StockholdersEquity"), "roa": _over("NetIncomeLoss", "Assets"), "ros": _over("NetIncomeLoss", "Revenues"),
        "gross_margin": _over("GrossProfit", "Revenues"), "operating_margin": _over("OperatingIncomeLoss", "Revenues"),
        "debt_ratio": _over("Liabilities", "Assets"), "debt_to_equity": _over("Liabilities", "StockholdersEquity"),
        "free_cash_flow": c("OperatingCashFlow") - c("CapitalExpenditures"), "ocf_ratio": _over("OperatingCashFlow", "Revenues"), "capex_ratio": _over("CapitalExpenditures", "Assets"),
        "current_ratio": _over("AssetsCurrent", "LiabilitiesCurrent"), "quick_ratio": F.when(c("LiabilitiesCurrent") > 0, (c("AssetsCurrent") - c("Inventory")) / c("LiabilitiesCurrent")),
        "price_to_book": valued("StockholdersEquity"), "price_to_sales": valued("Revenues"), "price_to_earnings": valued("NetIncomeLoss"), "pe_ratio": _over("close", "EarningsPerShareDiluted", "close"),
        "dividend_yield": _over("dividend_amount", "close"), "payout_ratio": F.when(c("NetIncomeLoss") > 0, c("dividend_amount") * c("shares_outstanding") / c("NetIncomeLoss")),
        "asset_turnover": _over("Revenues", "Assets"), "inventory_turnover": _over("Revenues", "Inventory", "Revenues"),
    }


def with_ratios(rows: DataFrame) -> DataFrame:
    return rows.withColumns(ratio_columns())


TTM = {"revenue_ttm": "Revenues", "net_income_ttm": "NetIncomeLoss", "ocf_ttm": "OperatingCashFlow", "capex_ttm": "CapitalExpenditures", "fcf_ttm": "free_cash_flow"}
#: Two countries may share a ticker and a month.
_BY_DATE = ["date", "country"]


def with_ttm(rows: DataFrame) -> DataFrame:
    """Sums over the last 12 rows of the ticker (months, of quarterly values carried forward)."""
    order = [F.col(c) for c in _BY_DATE]
    return rows.withColumns({name: rolling_sum(c, ["ticker"], order, 12) for name, c in TTM.items()})


def with_lag12(rows: DataFrame) -> DataFrame:
    w = W.partitionBy("ticker").orderBy(*_BY_DATE)
    return rows.withColumns({"revenues_12m_ago": F.lag("Revenues", 12).over(w), "net_income_12m_ago": F.lag("NetIncomeLoss", 12).over(w)})


def with_growth(rows: DataFrame) -> DataFrame:
    growth = lambda x, before: F.when(F.col(before) != 0, (F.col(x) - F.col(before)) / F.abs(before))
    return rows.withColumns({"revenue_growth": growth("Revenues", "revenues_12m_ago"), "net_income_growth": growth("NetIncomeLoss", "net_income_12m_ago")})


def columns() -> list[str]:
    """The 88 columns of the table."""
    return ["ticker", "date", "end_date", "filing_date", "fiscal_quarter", "country", *CONCEPTS, "high", "low", "close", "sector", "industry", "shares_outstanding", "dividend_amount", *MACRO, *RATIOS, *TTM, "revenue_growth", "net_income_growth"]


def fullest(rows: DataFrame) -> DataFrame:
    """One row per (ticker, date): the one with the fewest blanks in five columns, then the newest report."""
    blanks = sum((F.col(c).isNull().cast("int") for c in ("Assets", "Liabilities", "Revenues", "NetIncomeLoss", "close")), F.lit(0))
    order = [blanks.asc(), F.col("end_date").desc_nulls_last(), F.col("filing_date").desc_nulls_last(), F.col("country").asc()]
    return dedup_by(rows, ["ticker", "date"], order)


def build(wide: DataFrame, prices: DataFrame, sectors: DataFrame, shares: DataFrame, dividends: DataFrame, macro: DataFrame, as_of: datetime.date) -> DataFrame:
    reports = first_reports(published(wide, as_of))
    rows = with_reports(monthly_spine(reports), reports)
    rows = with_macro(with_dividends(with_shares(with_prices_sectors(rows, prices, sectors), shares), dividends), macro)
    return fullest(with_growth(with_lag12(with_ttm(with_ratios(rows))))).select(*columns())


def coverage(master: DataFrame) -> DataFrame:
    """Counts of rows, companies and months, and of filled columns."""
    filled = [F.count(c).alias(f"with_{c}") for c in ("Assets", "Revenues", "NetIncomeLoss", "close", "shares_outstanding", "sector")]
    return master.agg(F.count("*").alias("n_rows"), F.countDistinct("ticker").alias("n_tickers"), F.countDistinct("date").alias("n_dates"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), *filled)
