"""Declared tables of the landing layer, with their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(text: str) -> T.StructType:
    kinds = {"string": T.StringType(), "date": T.DateType(), "double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (c.split() for c in text.split(", "))])


TABLES: dict[str, T.StructType] = {
    "prices": _schema("ticker string, date date, country string, open double, high double, low double, close double, volume bigint"),
    "financials": _schema("ticker string, concept string, country string, unit string, start_date date, end_date date, value double, form string, filing_date date, value_source string"),
    "macro": _schema("date date, inflation_usa double, inflation_pl double, unemployment_rate_usa double, unemployment_rate_pl double, interest_rate_usa double, interest_rate_pl double, gdp_real_usa double, retail_sales_usa double, gdp_real_pl double, retail_sales_index_pl double"),
    "dividends": _schema("ticker string, dividend_date date, country string, dividend_amount double"),
    "sectors": _schema("ticker string, country string, sector string, industry string, last_updated timestamp"),
    "shares_outstanding": _schema("ticker string, filing_date date, country string, shares bigint, end_date date, fiscal_year int, fiscal_period string, source_type string"),
    "company_metadata": _schema("cik string, ticker string, country string, company_name string, sic int, sic_description string, exchange string, is_excluded boolean"),
    "company_status": _schema("ticker string, country string, cik string, status string, delisting_date date, delisting_form string, last_filing_date date, last_financial_report_date date"),
}
KEYS: dict[str, list[str]] = {
    "prices": ["ticker", "date", "country"],
    "financials": ["ticker", "concept", "start_date", "end_date"],
    "macro": ["date"],
    "dividends": ["ticker", "dividend_date", "country"],
    "sectors": ["ticker", "country"],
    "shares_outstanding": ["ticker", "filing_date", "country"],
    "company_metadata": ["cik", "ticker", "country"],
    "company_status": ["ticker", "country"],
}


def conform(df: DataFrame, table: str, more: bool = False) -> DataFrame:
    """The declared columns in order and type; missing ones null (country: US).  Others are left out, or follow as they are (``more``)."""
    default = {"country": F.lit("US")}
    others = [F.col(f"`{c}`") for c in df.columns if more and c not in TABLES[table].names]
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else default.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name) for f in TABLES[table]], *others)
