"""The batch jobs: landing files to tables, tables to the labelled monthly table, and the analysis reports."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundalake.operators import stats
from fundalake.plans.refresh import refresh
from fundalake.sources import files
from fundalake.sources.schemas import KEYS
from fundalake.sources.store import Store, write_csv

#: Which macro file is which column.
MACRO_FILES = {f"{c}.csv": c for c in ("inflation_usa", "inflation_pl", "unemployment_rate_usa", "unemployment_rate_pl", "interest_rate_usa", "interest_rate_pl", "gdp_real_usa", "retail_sales_usa", "gdp_real_pl", "retail_sales_index_pl")}


def scans(spark: SparkSession, raw: str) -> dict[str, Callable[[], DataFrame]]:
    """The scan of each table below a folder of landed files."""
    return {
        "prices": lambda: files.prices(spark, f"{raw}/prices"),
        "financials": lambda: files.financials(spark, f"{raw}/financials"),
        "macro": lambda: files.macro(spark, f"{raw}/macro", MACRO_FILES),
        "dividends": lambda: files.dividends(spark, f"{raw}/dividends"),
        "sectors": lambda: files.sectors(spark, f"{raw}/sectors"),
        "shares_outstanding": lambda: files.shares(spark, f"{raw}/shares"),
        "company_metadata": lambda: files.company_metadata(spark, f"{raw}/company_metadata"),
        "company_status": lambda: files.company_status(spark, f"{raw}/company_status"),
    }


def load(spark: SparkSession, store: Store, raw: str, only_existing: bool = False) -> dict[str, int]:
    """Upsert all tables from their files; rows per table.  ``only_existing`` skips tables that are not there yet, and folders that are missing are skipped."""
    counts = {}
    for name, scan in scans(spark, raw).items():
        folder = {"shares_outstanding": "shares"}.get(name, name)
        fs, path = store._fs(f"{raw}/{folder}")
        if not fs.exists(path) or (only_existing and not store.exists(name)):
            continue
        store.upsert(name, scan(), KEYS[name])
        counts[name] = store.read(name).count()
    return counts


def update(spark: SparkSession, store: Store, raw: str, as_of: datetime.date) -> dict[str, int]:
    """The whole refresh: a first build if there are no prices yet, otherwise an update of what is there, and of what follows from that."""
    counts = load(spark, store, raw, only_existing=store.exists("prices"))
    refresh(store, as_of)
    return counts


def analyse(store: Store, out: str, tickers: list[str] | None = None) -> None:
    """Description and correlations of prices as CSV."""
    prices = store.read("prices_cleaned")
    prices = prices.filter(F.col("ticker").isin(*tickers)) if tickers else prices
    columns = ["open", "high", "low", "close", "volume"]
    write_csv(stats.describe(prices, columns), f"{out}/describe")
    write_csv(stats.correlations(prices, columns), f"{out}/correlations")
