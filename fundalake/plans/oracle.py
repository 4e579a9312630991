"""The same results in DuckDB SQL: named parts that are put together into one statement."""

from __future__ import annotations

import re

from fundalake.plans.constants import CONCEPTS, MACRO
from fundalake.sources import proxies

AS_OF = "DATE '2001-12-31'"
FILINGS_AS_OF = "DATE '2024-02-01'"

_items = ", ".join(CONCEPTS)
_macro = ", ".join(MACRO)
_months = "CAST(round(date_diff('day', start_date, end_date) / 30.44) AS INTEGER)"
_pub = "CAST(date_trunc('month', CAST({} + INTERVAL 1 DAY AS DATE)) + INTERVAL 1 MONTH AS DATE)"
_dec = "CAST(sum(CAST({} AS DECIMAL(28,6))) {} AS DOUBLE)"


def _yoy(c: str) -> str:
    return f"({c} / nullif(lag({c}, 12) OVER w, 0) - 1) * 100"


def _country(code: str, suffix: str, retail: str, cpi: str) -> str:
    u, r = f"unemployment_rate_{suffix}", f"interest_rate_{suffix}"
    return f"""SELECT date AS period_date, '{code}' AS country, CAST(date_trunc('month', date) + INTERVAL 1 MONTH AS DATE) AS publication_date, {_yoy(retail)} AS retail_sales_yoy, {_yoy(f"gdp_real_{suffix}")} AS gdp_yoy, {cpi} AS cpi_yoy,
  {u} AS unemp_level, {u} - lag({u}) OVER w AS unemp_diff, {r} AS rate_level, {r} - lag({r}) OVER w AS rate_diff FROM px_macro WINDOW w AS (ORDER BY date)"""


#: The definitions of the ratios.
RATIOS = {
    "revenue_per_share": "CASE WHEN shares_outstanding > 0 THEN Revenues / shares_outstanding END",
    "operating_income_per_share": "CASE WHEN shares_outstanding > 0 THEN OperatingIncomeLoss / shares_outstanding END",
    "assets_per_share": "CASE WHEN shares_outstanding > 0 THEN Assets / shares_outstanding END",
    "rnd_per_share": "CASE WHEN shares_outstanding > 0 THEN ResearchAndDevelopment / shares_outstanding END",
    "sga_per_share": "CASE WHEN shares_outstanding > 0 THEN GeneralAndAdministrativeExpense / shares_outstanding END",
    "net_income_per_share": "CASE WHEN shares_outstanding > 0 THEN NetIncomeLoss / shares_outstanding END",
    "roe": "CASE WHEN StockholdersEquity > 0 THEN NetIncomeLoss / StockholdersEquity END",
    "roa": "CASE WHEN Assets > 0 THEN NetIncomeLoss / Assets END",
    "ros": "CASE WHEN Revenues > 0 THEN NetIncomeLoss / Revenues END",
    "gross_margin": "CASE WHEN Revenues > 0 THEN GrossProfit / Revenues END",
    "operating_margin": "CASE WHEN Revenues > 0 THEN OperatingIncomeLoss / Revenues END",
    "debt_ratio": "CASE WHEN Assets > 0 THEN Liabilities / Assets END",
    "debt_to_equity": "CASE WHEN StockholdersEquity > 0 THEN Liabilities / StockholdersEquity END",
    "free_cash_flow": "OperatingCashFlow - CapitalExpenditures",
    "ocf_ratio": "CASE WHEN Revenues > 0 THEN OperatingCashFlow / Revenues END",
    "capex_ratio": "CASE WHEN Assets > 0 THEN CapitalExpenditures / Assets END",
    "current_ratio": "CASE WHEN LiabilitiesCurrent > 0 THEN AssetsCurrent / LiabilitiesCurrent END",
    "quick_ratio": "CASE WHEN LiabilitiesCurrent > 0 THEN (AssetsCurrent - Inventory) / LiabilitiesCurrent END",
    "price_to_book": "CASE WHEN close > 0 AND shares_outstanding > 0 AND StockholdersEquity > 0 THEN close * shares_outstanding / StockholdersEquity END",
    "price_to_sales": "CASE WHEN close > 0 AND shares_outstanding > 0 AND Revenues > 0 THEN close * shares_outstanding / Revenues END",
    "price_to_earnings": "CASE WHEN close > 0 AND shares_outstanding > 0 AND NetIncomeLoss > 0 THEN close * shares_outstanding / NetIncomeLoss END",
    "pe_ratio": "CASE WHEN close > 0 AND EarningsPerShareDiluted > 0 THEN close / EarningsPerShareDiluted END",
    "dividend_yield": "CASE WHEN close > 0 THEN dividend_amount / close END",
    "payout_ratio": "CASE WHEN NetIncomeLoss > 0 THEN dividend_amount * shares_outstanding / NetIncomeLoss END",
    "asset_turnover": "CASE WHEN Assets > 0 THEN Revenues / Assets END",
    "inventory_turnover": "CASE WHEN Inventory > 0 AND Revenues > 0 THEN Revenues / Inventory END",
}
TTM = {"revenue_ttm": "Revenues", "net_income_ttm": "NetIncomeLoss", "ocf_ttm": "OperatingCashFlow", "capex_ttm": "CapitalExpenditures", "fcf_ttm": "free_cash_flow"}
MASTER_COLUMNS = f"ticker, date, end_date, filing_date, fiscal_quarter, country, {_items}, high, low, close, sector, industry, shares_outstanding, dividend_amount, {_macro}, {', '.join(RATIOS)}, {', '.join(TTM)}, revenue_growth, net_income_growth"
_blanks = " + ".join(f"CAST({c} IS NULL AS INT)" for c in ("Assets", "Liabilities", "Revenues", "NetIncomeLoss", "close"))
_part = "coalesce({} / nullif(Assets, 0), 0)"

PARTS: dict[str, str] = {f"px_{n}": proxies.oracle(n) for n in proxies.SQL} | {
    "facts_classified": "SELECT *, CASE WHEN start_date IS NULL THEN 'snapshot' WHEN round_even(date_diff('day', start_date, end_date) / 30.44, 0) BETWEEN 2 AND 4 THEN 'discrete' ELSE 'cumulative' END AS value_source FROM px_financials",
    "facts_unique": "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY ticker, concept, end_date ORDER BY CAST(value_source = 'cumulative' AS INT), filing_date DESC NULLS LAST, value DESC NULLS LAST, fact_id) AS rn FROM facts_classified) WHERE rn = 1",
    "first_filings": "SELECT ticker, end_date, min(filing_date) AS first_filing_date FROM px_financials WHERE filing_date IS NOT NULL GROUP BY 1, 2",
    "nearest": "SELECT ticker, end_date, filing_date AS nearest_filing_date, form AS nearest_form FROM (SELECT *, row_number() OVER (PARTITION BY ticker, end_date ORDER BY filing_date, form NULLS LAST) AS rn FROM facts_unique WHERE filing_date > end_date) WHERE rn = 1",
    "facts_filled": "SELECT f.ticker, f.concept, f.country, f.unit, f.start_date, f.end_date, f.value, f.value_source, coalesce(f.form, n.nearest_form, 'forecasted') AS form, coalesce(f.filing_date, n.nearest_filing_date, CAST(f.end_date + INTERVAL 1 MONTH AS DATE)) AS filing_date FROM facts_unique f LEFT JOIN nearest n ON f.ticker = n.ticker AND f.end_date = n.end_date WHERE f.value IS NOT NULL AND f.end_date IS NOT NULL",
    "facts_lagged": f"SELECT *, {_months} AS months, lag(value) OVER (PARTITION BY ticker, concept, year(start_date) ORDER BY end_date) AS before, count(*) OVER (PARTITION BY ticker, concept, year(start_date)) AS reports FROM facts_filled",
    "facts_quarter": """SELECT *, CASE WHEN start_date IS NULL OR months IN (2, 3, 4) THEN CAST(quarter(end_date) AS VARCHAR) WHEN months IN (5, 6, 7) THEN '2' WHEN months IN (8, 9, 10) THEN '3' WHEN months >= 11 THEN CASE WHEN reports = 1 THEN 'FY' ELSE '4' END ELSE 'OTHER' END AS fiscal_quarter FROM facts_lagged""",
    "facts_clean": """SELECT ticker, concept, country, unit, end_date, fiscal_quarter, filing_date, form,
  CASE WHEN start_date IS NULL OR value_source = 'discrete' OR before IS NULL THEN value ELSE value - before END AS value_quarterly,
  CASE WHEN start_date IS NULL THEN 'snapshot' WHEN value_source = 'discrete' OR before IS NULL THEN 'direct' ELSE 'calculated' END AS value_quarterly_source,
  CASE WHEN start_date IS NULL THEN 'SNAPSHOT' ELSE 'FLOW' END AS period_type, CASE WHEN start_date IS NOT NULL THEN months END AS period_length_months,
  count(DISTINCT fiscal_quarter) OVER (PARTITION BY ticker, concept, year(end_date)) AS quarters_available, count(DISTINCT fiscal_quarter) OVER (PARTITION BY ticker, concept, year(end_date)) >= 4 AS year_complete FROM facts_quarter""",
    "flows": "SELECT ticker, country, end_date, min(fiscal_quarter) AS fiscal_quarter FROM facts_clean WHERE period_type = 'FLOW' GROUP BY 1, 2, 3",
    "snapshots": "SELECT DISTINCT ticker, country, end_date AS snapshot_date FROM facts_clean WHERE period_type = 'SNAPSHOT'",
    "snapshot_flow": "SELECT s.ticker, s.country, s.snapshot_date, f.end_date AS flow_date FROM snapshots s ASOF JOIN flows f ON s.ticker = f.ticker AND s.country = f.country AND s.snapshot_date <= f.end_date WHERE date_diff('day', s.snapshot_date, f.end_date) <= 365",
    "facts_redated": """SELECT c.ticker, c.country, f.end_date, c.period_type, c.concept, c.unit, c.filing_date, c.form, c.value_quarterly, c.value_quarterly_source, c.period_length_months, c.quarters_available, c.year_complete, f.fiscal_quarter
  FROM facts_clean c LEFT JOIN snapshot_flow m ON c.ticker = m.ticker AND c.country = m.country AND c.end_date = m.snapshot_date AND c.period_type = 'SNAPSHOT'
  JOIN flows f ON c.ticker = f.ticker AND c.country = f.country AND coalesce(m.flow_date, c.end_date) = f.end_date""",
    "fin_wide": f"SELECT ticker, end_date, fiscal_quarter, country, max(filing_date) AS filing_date, {', '.join(f'''max(CASE WHEN concept = '{c}' THEN value_quarterly END) AS {c}''' for c in CONCEPTS)} FROM facts_redated GROUP BY 1, 2, 3, 4",
    "prices_clean": "SELECT * FROM px_prices WHERE close IS NOT NULL AND close > 0",
    "dividends_clean": "SELECT * FROM px_dividends WHERE dividend_amount > 0",
    "sectors_clean": "SELECT * FROM px_sectors WHERE sector IS NOT NULL",
    "shares_clean": "SELECT ticker, filing_date, country, shares, CASE fiscal_period WHEN 'Q1' THEN make_date(fiscal_year, 3, 31) WHEN 'Q2' THEN make_date(fiscal_year, 6, 30) WHEN 'Q3' THEN make_date(fiscal_year, 9, 30) WHEN 'Q4' THEN make_date(fiscal_year, 12, 31) WHEN 'FY' THEN make_date(fiscal_year, 12, 31) ELSE end_date END AS end_date, fiscal_year, fiscal_period, source_type FROM px_shares WHERE shares > 0",
    "macro_norm": f"SELECT * FROM ({_country('US', 'usa', 'retail_sales_usa', _yoy('inflation_usa'))} UNION ALL {_country('PL', 'pl', 'retail_sales_index_pl', 'inflation_pl')}) WHERE coalesce({_macro}) IS NOT NULL",
    "published": f"SELECT *, {_pub.format('coalesce(filing_date, end_date)')} AS publication_date FROM fin_wide WHERE (filing_date IS NULL OR filing_date <= {AS_OF} + INTERVAL 1 YEAR) AND (end_date IS NULL OR end_date <= {AS_OF} + INTERVAL 1 YEAR) AND (filing_date IS NULL OR date_diff('day', filing_date, {_pub.format('filing_date')}) <= 31)",
    "reports": "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY ticker, country, publication_date ORDER BY end_date, fiscal_quarter) AS rn FROM published) WHERE rn = 1",
    "spine": "SELECT ticker, country, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS date FROM (SELECT ticker, country, min(publication_date) AS a, max(publication_date) AS b FROM reports GROUP BY 1, 2)",
    "carried": f"SELECT s.ticker, s.date, s.country, {', '.join(f'''CASE WHEN date_diff('day', r.publication_date, s.date) <= 150 THEN r.{c} END AS {c}''' for c in ('end_date', 'filing_date', 'fiscal_quarter', *CONCEPTS))} FROM spine s ASOF LEFT JOIN reports r ON s.ticker = r.ticker AND s.country = r.country AND s.date >= r.publication_date",
    "priced": "SELECT c.*, p.high, p.low, p.close, s.sector, s.industry FROM carried c LEFT JOIN prices_clean p ON c.ticker = p.ticker AND c.country = p.country AND c.date = p.date LEFT JOIN sectors_clean s ON c.ticker = s.ticker AND c.country = s.country",
    "shares_one": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker, country, end_date ORDER BY filing_date DESC NULLS LAST, shares DESC) AS rn FROM shares_clean) WHERE rn = 1",
    "shared": "SELECT p.*, s.shares AS shares_outstanding FROM priced p ASOF LEFT JOIN shares_one s ON p.ticker = s.ticker AND p.country = s.country AND p.date >= s.end_date",
    "dividends_month": f"SELECT ticker, country, CAST(date_trunc('month', dividend_date) AS DATE) AS month_start, {_dec.format('dividend_amount', '')} AS dividend_amount FROM dividends_clean GROUP BY 1, 2, 3",
    "known": f"SELECT s.*, d.dividend_amount, {', '.join(f'm.{c}' for c in MACRO)} FROM shared s LEFT JOIN dividends_month d ON s.ticker = d.ticker AND s.country = d.country AND s.date = d.month_start ASOF LEFT JOIN macro_norm m ON s.country = m.country AND s.date >= m.publication_date",
    "rated": f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in RATIOS.items())} FROM known",
    "summed": f"SELECT *, {', '.join(_dec.format(c, 'OVER w12') + f' AS {k}' for k, c in TTM.items())}, lag(Revenues, 12) OVER w AS revenues_12m_ago, lag(NetIncomeLoss, 12) OVER w AS net_income_12m_ago FROM rated WINDOW w AS (PARTITION BY ticker ORDER BY date, country), w12 AS (PARTITION BY ticker ORDER BY date, country ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)",
    "grown": "SELECT *, CASE WHEN revenues_12m_ago <> 0 THEN (Revenues - revenues_12m_ago) / abs(revenues_12m_ago) END AS revenue_growth, CASE WHEN net_income_12m_ago <> 0 THEN (NetIncomeLoss - net_income_12m_ago) / abs(net_income_12m_ago) END AS net_income_growth FROM summed",
    "master": f"SELECT {MASTER_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY {_blanks}, end_date DESC NULLS LAST, filing_date DESC NULLS LAST, country) AS rn FROM grown) WHERE rn = 1",
    "censored": "SELECT m.*, s.status, s.delisting_date FROM master m LEFT JOIN px_status s ON m.ticker = s.ticker WHERE s.status = 'ACTIVE' OR s.status IS NULL OR (s.status IN ('DELISTED', 'DEREGISTERED') AND m.date <= s.delisting_date)",
    "profile": f"""SELECT ticker, min(CASE WHEN StockholdersEquity < 0 THEN 1 ELSE 0 END) AS ever_negative_equity, {', '.join(f'avg(CASE WHEN {c} < 0 THEN 1.0::DOUBLE ELSE 0.0 END) AS {n}' for c, n in (('StockholdersEquity', 'pct_negative_equity'), ('NetIncomeLoss', 'pct_negative_income'), ('OperatingCashFlow', 'pct_negative_ocf')))},
  avg(coalesce(debt_ratio, 0)) AS avg_debt_ratio, avg(coalesce(current_ratio, 999)) AS avg_current_ratio,
  avg(CASE WHEN Assets > 0 AND Liabilities > 0 THEN 1.2 * {_part.format('(AssetsCurrent - LiabilitiesCurrent)')} + 1.4 * {_part.format('RetainedEarnings')} + 3.3 * {_part.format('OperatingIncomeLoss')} + 1.0 * {_part.format('Revenues')} END) AS avg_altman_partial
  FROM censored WHERE status IN ('DELISTED', 'DEREGISTERED') GROUP BY ticker""",
    "votes": f"SELECT ticker, {' + '.join(f'CASE WHEN {c} THEN 1 ELSE 0 END' for c in ('ever_negative_equity = 1', 'pct_negative_income > 0.5', 'pct_negative_ocf > 0.5', 'avg_debt_ratio > 0.8', 'avg_current_ratio < 1.0', 'avg_altman_partial < 1.8'))} AS distress_signals FROM profile",
    "targeted": "SELECT c.*, CASE WHEN c.status IN ('DELISTED', 'DEREGISTERED') AND v.distress_signals >= 2 THEN 1 ELSE 0 END AS target_bankruptcy FROM censored c LEFT JOIN votes v ON c.ticker = v.ticker",
    "labelled": f"SELECT {MASTER_COLUMNS}, status, delisting_date, target_bankruptcy FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY end_date DESC NULLS LAST, filing_date DESC NULLS LAST) AS rn FROM targeted) WHERE rn = 1",
    "latest": "SELECT * EXCLUDE last_date FROM (SELECT *, max(date) OVER (PARTITION BY ticker) AS last_date FROM master) WHERE date = last_date",
}
_NAMES = list(PARTS)


def statement(select: str, more: dict[str, str] | None = None) -> str:
    """``select`` with all the parts that it needs before it."""
    parts = PARTS | (more or {})
    need: set[str] = set()

    def visit(sql: str) -> None:
        for name in set(re.findall(r"\w+", sql)) & parts.keys() - need:
            need.add(name)
            visit(parts[name])

    visit(select)
    ctes = [f"{n} AS ({parts[n]})" for n in parts if n in need]
    return f"WITH {', '.join(ctes)} {select}" if ctes else select
