"""The registered queries and the SQL that each of them is held against."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundalake.operators import asof, boosting, cleaning, features, isotonic, labels, landing, master, models, screener, stats
from fundalake.plans import constants as K
from fundalake.operators.ranks import long
from fundalake.plans.oracle import FILINGS_AS_OF, MASTER_COLUMNS, RATIOS, TTM, statement
from fundalake.plans.refresh import refresh
from fundalake.sources import files, proxies, staging, store
from fundalake.sources.schemas import conform
from fundalake.streaming.ingest import ingest

AS_OF = datetime.date(2001, 12, 31)
FILINGS_DAY = datetime.date(2024, 2, 1)
#: Rounds of the registered second-order boosting: each level of a tree is a job, so all 300 take long on small tables.
BOOST_ROUNDS = 20


class Data:
    """The domain tables of a data folder, and what is built on them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def px(self, name: str) -> DataFrame:
        """A domain table; what only depends on a row a day or month of the base table is staged, so that this is read once."""
        if name in proxies.BY_DAY:
            return proxies.by_day(name, self._stage("days", lambda: proxies.days(self.spark, self.sf_dir)))
        if name == "macro":
            dearest = lambda: staging.folder(self.spark, self.sf_dir, "orders", "dearest", lambda: proxies.dearest_orders(self.spark, self.sf_dir))
            return self._stage("px-macro", lambda: proxies.view(self.spark, dearest(), name))
        return proxies.view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return staging.staged(self.spark, self.sf_dir, name, make)

    def _leading(self) -> str:
        """A folder with the orders that ``unique`` can keep: they are found by numbers, before any text is made or sorted."""
        at = self.spark, self.sf_dir
        ranks = lambda: self._stage("ranks", lambda: proxies.fact_ranks(*at))
        return staging.folder(*at, "orders", "leading", lambda: proxies.leading_orders(*at, ranks()))

    @cached_property
    def classified(self) -> DataFrame:
        return cleaning.classify_period(self.px("financials"))

    @cached_property
    def unique(self) -> DataFrame:
        return self._stage("unique", lambda: cleaning.dedup_facts(cleaning.classify_period(proxies.view(self.spark, self._leading(), "financials"))))

    @cached_property
    def filled(self) -> DataFrame:
        return cleaning.fill_facts(self.unique)

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.quarterly(self.filled)

    @cached_property
    def wide(self) -> DataFrame:
        return cleaning.wide(cleaning.redate(self.clean))

    @cached_property
    def prices(self) -> DataFrame:
        return cleaning.clean_prices(self.px("prices"))

    @cached_property
    def reports(self) -> DataFrame:
        return master.first_reports(master.published(self.wide, AS_OF))

    @cached_property
    def carried(self) -> DataFrame:
        return master.with_reports(master.monthly_spine(self.reports), self.reports)

    @cached_property
    def known(self) -> DataFrame:
        rows = master.with_prices_sectors(self.carried, self.prices, cleaning.clean_sectors(self.px("sectors")))
        rows = master.with_shares(rows, cleaning.clean_shares(self.px("shares")))
        return master.with_macro(master.with_dividends(rows, cleaning.clean_dividends(self.px("dividends"))), cleaning.normalize_macro(self.px("macro")))

    @cached_property
    def master(self) -> DataFrame:
        return self._stage("master", lambda: master.fullest(master.with_growth(master.with_lag12(master.with_ttm(master.with_ratios(self.known))))).select(*master.columns()))

    @cached_property
    def censored(self) -> DataFrame:
        return labels.censor(self.master, self.px("status"))

    @cached_property
    def labelled(self) -> DataFrame:
        return self._stage("labelled", lambda: labels.build(self.master, self.px("status")))


_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None, **more: str):
    """Register a function of Data; ``sql`` may use the oracle's parts, and ``more`` adds some."""

    def put(make: Callable[[Data], DataFrame]):
        _queries[name] = lambda spark, sf_dir: make(Data(spark, sf_dir))
        if sql is not None:
            _sql[name] = statement(sql, more)
        return make

    return put


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _r(digits: int, *columns: str) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


# ---- ingest
query("classify_period", "SELECT fact_id, value_source FROM facts_classified")(lambda d: d.classified.select("fact_id", "value_source"))
query("dedup_facts", "SELECT fact_id, ticker, concept, end_date, value, value_source FROM facts_unique")(lambda d: d.unique.select("fact_id", "ticker", "concept", "end_date", "value", "value_source"))
query("fill_filing_date", "SELECT f.fact_id, coalesce(f.filing_date, g.first_filing_date) AS filing_date FROM facts_unique f LEFT JOIN first_filings g ON f.ticker = g.ticker AND f.end_date = g.end_date")(lambda d: cleaning.fill_filing_dates(d.unique, d.px("financials")).select("fact_id", "filing_date"))
query("first_filing", "SELECT * FROM first_filings")(lambda d: cleaning.first_filings(d.px("financials")))
_SERIES = ["gdp_real_pl", "gdp_real_usa", "inflation_pl", "inflation_usa", "interest_rate_pl", "interest_rate_usa", "retail_sales_index_pl", "retail_sales_usa", "unemployment_rate_pl", "unemployment_rate_usa"]
query("macro_pivot", "SELECT * FROM px_macro")(lambda d: files.pivot_series(d.px("macro").unpivot("date", _SERIES, "series", "value").withColumn("_i", F.lit(0)), _SERIES))
query("derive_country", "SELECT DISTINCT ticker, CASE WHEN suffix(ticker, '.PL') THEN 'PL' ELSE 'US' END AS country FROM px_prices")(lambda d: d.px("prices").select("ticker", cleaning.country_of(F.col("ticker")).alias("country")).distinct())
query("upsert", "SELECT ticker, date, country, close, volume FROM px_prices WHERE date < DATE '1998-06-01' AND NOT (date >= DATE '1998-01-01') UNION ALL SELECT ticker, date, country, close + 1, volume FROM px_prices WHERE date >= DATE '1998-01-01'")(
    lambda d: (lambda p: store.upsert(p.filter("date < '1998-06-01'"), p.filter("date >= '1998-01-01'").withColumn("close", F.col("close") + 1), ["ticker", "date", "country"]))(d.px("prices").select("ticker", "date", "country", "close", "volume"))
)
query("upsert_macro", "SELECT period_date, country, CASE WHEN period_date >= DATE '1998-01-01' THEN -unemp_level ELSE unemp_level END AS unemp_level FROM macro_norm")(
    lambda d: (lambda m: store.upsert(m, m.filter("period_date >= '1998-01-01'").withColumn("unemp_level", -F.col("unemp_level")), ["period_date", "country"]))(cleaning.normalize_macro(d.px("macro")).select("period_date", "country", "unemp_level"))
)
query("table_range", "SELECT count(*) AS n_rows, min(date) AS min_date, max(date) AS max_date FROM px_prices WHERE country = 'PL'")(lambda d: store.table_range(d.px("prices"), "date", "PL"))
_STATS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, count(DISTINCT {e}) AS n_entities, {f'min({c}), max({c})' if c else 'CAST(NULL AS DATE), CAST(NULL AS DATE)'} FROM px_{t}" for t, c, e in (("prices", "date", "ticker"), ("financials", "end_date", "ticker"), ("macro", "date", "date"), ("dividends", "dividend_date", "ticker"), ("sectors", None, "ticker"), ("shares", "filing_date", "ticker")))
query("table_stats", f"SELECT * FROM ({_STATS}) AS t(table_name, n_rows, n_entities, min_date, max_date)")(
    lambda d: store.table_stats({"prices": (d.px("prices"), "date", "ticker"), "financials": (d.px("financials"), "end_date", "ticker"), "macro": (d.px("macro"), "date", "date"), "dividends": (d.px("dividends"), "dividend_date", "ticker"), "sectors": (d.px("sectors"), None, "ticker"), "shares": (d.px("shares"), "filing_date", "ticker")})
)
query("filtered_prices", "SELECT * FROM prices_clean WHERE country = 'US' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND ticker IN ('T1', 'T2', 'T3')")(lambda d: store.filtered(d.prices, "date", ["T1", "T2", "T3"], "1996-01-01", "1997-12-31", "US"))
query("scan_where_limit", "SELECT ticker, date, close FROM prices_clean WHERE close > 20000 ORDER BY ticker, date LIMIT 100")(lambda d: store.load(d.prices.orderBy("ticker", "date"), ["ticker", "date", "close"], "close > 20000", 100))
query("adhoc_sql", "SELECT country, count(*) AS n FROM prices_clean WHERE close > 1000 GROUP BY country")(lambda d: d.spark.sql("SELECT country, count(*) AS n FROM {p} WHERE close > :low GROUP BY country", args={"low": 1000}, p=d.prices))

# ---- scans of landed files, sinks and the store
def _landed(d: Data, name: str, rows: DataFrame, file, form: str) -> str:
    return staging.landed(d.spark, d.sf_dir, name, rows, file, form)


def _price_files(d: Data) -> str:
    """The newest file of each country, and an older one of the US that is not to be read."""
    p = d.px("prices").select(F.col("ticker").alias("Ticker"), F.col("date").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"), F.col("volume").alias("Volume"))
    both = p.withColumn("_f", F.when(F.col("Ticker").endswith(".PL"), "prices_pl_2.csv").otherwise("prices_2.csv")).unionByName(p.withColumn("Close", F.col("Close") + 1).withColumn("_f", F.lit("prices_1.csv")))
    return _landed(d, "prices", both.withColumn("_file", F.col("_f")).drop("_f"), F.col("_file"), "csv")


def _per_ticker(d: Data, name: str, field: str, rows: DataFrame, suffix: str = ".json") -> str:
    """JSON files, one for each ticker, with the list of its records."""
    items = rows.groupBy("ticker").agg(F.collect_list(F.struct(*[c for c in rows.columns if c != "ticker"])).alias(field))
    return _landed(d, name, items, F.concat("ticker", F.lit(suffix)), "json")


def _fact_files(d: Data) -> str:
    f = d.px("financials").select("ticker", "concept", "unit", F.col("start_date").alias("start"), F.col("end_date").alias("end"), "value", "form", "filing_date")
    return _per_ticker(d, "financials", "financials", f, "_financials.json")


def _dividend_files(d: Data) -> str:
    return _per_ticker(d, "dividends", "dividends", d.px("dividends").select("ticker", F.col("dividend_date").alias("date"), F.col("dividend_amount").alias("dividend")))


def _share_files(d: Data) -> str:
    rows = d.px("shares").select("ticker", F.col("end_date").alias("end"), F.col("filing_date").alias("filed"), F.col("fiscal_year").cast("string").alias("fy"), F.col("fiscal_period").alias("fp"), F.col("shares").alias("value"), "source_type")
    return _per_ticker(d, "shares", "shares_history", rows)


def _sector_files(d: Data) -> str:
    """Three files; the last one renames the industries of a third of the tickers."""
    n = F.regexp_extract("Ticker", r"\d+", 0).cast("int") % 3
    s = d.px("sectors").select(F.col("ticker").alias("Ticker"), F.col("sector").alias("Sector"), F.col("industry").alias("Industry"))
    return _landed(d, "sectors", s.withColumn("_n", n).unionByName(s.filter(n == 0).withColumn("Industry", F.concat(F.lit("new "), F.col("Industry"))).withColumn("_n", F.lit(9))).withColumn("_file", F.format_string("sectors_%d.csv", F.col("_n").cast("int"))).drop("_n"), F.col("_file"), "csv")


def _status_files(d: Data) -> str:
    rows = d.px("status").select("ticker", F.regexp_extract("ticker", r"\d+", 0).alias("cik"), "status", "delisting_date", F.lit(None).cast("string").alias("delisting_form"), F.col("delisting_date").alias("last_filing_date"), F.lit("no date").alias("last_financial_report_date"))
    return _landed(d, "status", rows, F.lit("company_status.csv"), "csv")


def _macro_files(d: Data) -> str:
    rows = d.px("macro").unpivot("date", _SERIES, "series", "value").filter("value is not null")
    return _landed(d, "macro", rows.select("date", "value", F.concat("series", F.lit(".csv")).alias("_file")), F.col("_file"), "csv")


def _company_files(d: Data) -> str:
    """A file of companies for each region, of the customers: a company has one ticker or two."""
    c = d.table("customer").join(d.table("nation").withColumnsRenamed({"n_nationkey": "c_nationkey"}), "c_nationkey")
    tick = F.concat(F.lit("C"), F.col("c_custkey").cast("string"))
    row = F.struct(F.col("c_custkey").cast("string").alias("cik"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_nationkey").cast("string")).alias("sic"), F.col("c_mktsegment").alias("sic_description"), F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("N"), F.lit("Q"))).otherwise(F.array().cast("array<string>")).alias("exchanges"), F.when(F.col("c_custkey") % 4 == 0, F.array(tick, F.concat(tick, F.lit("B")))).otherwise(F.array(tick)).alias("all_tickers"))
    return _landed(d, "companies", c.groupBy("n_regionkey").agg(F.collect_list(row).alias("companies")).withColumn("_file", F.format_string("companies_%d.json", F.col("n_regionkey").cast("int"))).drop("n_regionkey"), F.col("_file"), "json")


def _store(d: Data) -> store.Store:
    return store.Store(d.spark, f"{staging.shared_dir(d.spark)}/store-{uuid.uuid4().hex}")


def _csv_sink(d: Data) -> DataFrame:
    path = f"{staging.shared_dir(d.spark)}/csv-{uuid.uuid4().hex}"
    store.write_csv(d.prices.select("ticker", "date", "close"), path)
    return d.spark.read.schema("ticker string, date date, close double").option("header", True).csv(path)


def _refresh(d: Data) -> DataFrame:
    s = _store(d)
    s.write("prices", d.px("prices"))
    s.refresh("prices", "prices_cleaned", cleaning.clean_prices, ["ticker", "date"])
    return s.read("prices_cleaned")


def _catalog(d: Data) -> DataFrame:
    s = _store(d)
    s.write("prices", d.px("prices"))
    s.write("sectors", d.px("sectors"))
    return s.canned("row_counts")


def _store_sql(d: Data) -> DataFrame:
    s = _store(d)
    s.write("prices", d.px("prices"))
    return s.sql("SELECT country, count(*) AS n, max(close) AS top FROM prices WHERE close > :low GROUP BY country", {"low": 1000})


def _ingest(d: Data) -> DataFrame:
    """The price table first, then a stream of files with later closes of some months."""
    s, path = _store(d), f"{staging.shared_dir(d.spark)}/new-{uuid.uuid4().hex}"
    p = conform(d.px("prices"), "prices")
    s.upsert("prices", p)
    p.filter("date >= '1998-01-01'").withColumn("close", F.col("close") + 1).write.parquet(path)
    ingest(d.spark, s, "prices", path, f"{path}-state", [F.col("close").desc_nulls_last()])
    return s.read("prices")


def _updated(d: Data) -> store.Store:
    """A store built from all but the later data of three companies and the last macro months; these then come as upserts, and the derived tables follow."""
    s = _store(d)
    late = lambda c, since: F.col("ticker").isin("T1", "T2", "T5.PL") & (F.col(c) >= since)
    tables = {
        "prices": (d.px("prices"), late("date", "1997-03-01")), "financials": (d.unique.drop("fact_id"), late("end_date", "1997-03-01")), "macro": (d.px("macro"), F.col("date") >= "1997-09-01"),
        "dividends": (d.px("dividends"), late("dividend_date", "1997-03-01")), "sectors": (d.px("sectors"), F.col("ticker") == "T1"), "shares_outstanding": (d.px("shares"), late("filing_date", "1997-03-01")),
        "company_status": (d.px("status"), F.col("ticker") == "T2"),
    }
    for part in (lambda c: ~c, lambda c: c):
        for name, (rows, is_late) in tables.items():
            s.upsert(name, rows.filter(part(F.coalesce(is_late, F.lit(False)))))
        refresh(s, AS_OF)
    return s


def _schemas(d: Data) -> DataFrame:
    s = _store(d)
    s.write("dividends", d.px("dividends"))
    return s.canned("schemas").join(s.canned("tables"), "table_name")


def _store_filtered(d: Data) -> DataFrame:
    s = _store(d)
    s.upsert("prices", d.px("prices"))
    return s.select("prices", "date", ["T1", "T2", "T3"], "1996-01-01", "1997-12-31", "US")


_PRICES = "ticker, date, country, open, high, low, close, volume"
query("scan_prices", f"SELECT {_PRICES} FROM px_prices")(lambda d: files.prices(d.spark, _price_files(d)))
query("scan_financials", "SELECT ticker, concept, country, unit, start_date, end_date, value, form, filing_date, value_source FROM (SELECT *, row_number() OVER (PARTITION BY ticker, concept, end_date ORDER BY CAST(value_source = 'cumulative' AS INT), filing_date DESC NULLS LAST, value DESC NULLS LAST, fact_id) AS rn FROM facts_classified) WHERE rn = 1")(lambda d: files.financials(d.spark, _fact_files(d)))
query("scan_macro", f"SELECT date, {', '.join(_SERIES)} FROM px_macro WHERE coalesce({', '.join(_SERIES)}) IS NOT NULL")(lambda d: files.macro(d.spark, _macro_files(d), {f"{c}.csv": c for c in _SERIES}))
query("scan_dividends", "SELECT ticker, dividend_date, country, dividend_amount FROM px_dividends")(lambda d: files.dividends(d.spark, _dividend_files(d), json=True))
query("scan_dividends_csv", "SELECT ticker, dividend_date, country, dividend_amount FROM px_dividends")(lambda d: files.dividends(d.spark, _landed(d, "dividends_csv", d.px("dividends").select(F.col("ticker").alias("Ticker"), F.col("dividend_date").alias("Date"), F.col("dividend_amount").alias("Dividend")), F.lit("dividends_1.csv"), "csv")))
query("scan_shares", "SELECT ticker, filing_date, country, shares, end_date, fiscal_year, fiscal_period, source_type FROM px_shares")(lambda d: files.shares(d.spark, _share_files(d)))
query("scan_status", "SELECT ticker, country, regexp_extract(ticker, '[0-9]+') AS cik, status, delisting_date, CAST(NULL AS VARCHAR) AS delisting_form, delisting_date AS last_filing_date, CAST(NULL AS DATE) AS last_financial_report_date FROM (SELECT *, CASE WHEN suffix(ticker, '.PL') THEN 'PL' ELSE 'US' END AS country FROM px_status)")(lambda d: files.company_status(d.spark, _status_files(d)))
query("scan_metadata", "SELECT CAST(c_custkey AS VARCHAR) AS cik, unnest(CASE WHEN c_custkey % 4 = 0 THEN ['C' || c_custkey, 'C' || c_custkey || 'B'] ELSE ['C' || c_custkey] END) AS ticker, 'US' AS country, c_name AS company_name, CAST(CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey END AS INT) AS sic, c_mktsegment AS sic_description, CASE WHEN c_custkey % 2 = 0 THEN 'N' END AS exchange, false AS is_excluded FROM customer")(lambda d: files.company_metadata(d.spark, _company_files(d)))
query("scan_sectors", "SELECT ticker, country, sector, CASE WHEN CAST(regexp_extract(ticker, '[0-9]+') AS INT) % 3 = 0 THEN 'new ' || industry ELSE industry END AS industry, CAST(NULL AS TIMESTAMP) AS last_updated FROM px_sectors")(lambda d: files.sectors(d.spark, _sector_files(d)))
query("csv_sink", "SELECT ticker, date, close FROM prices_clean")(_csv_sink)
query("catalog", "SELECT 'prices' AS table_name, count(*) AS n_rows FROM px_prices UNION ALL SELECT 'sectors', count(*) FROM px_sectors")(_catalog)
query("store_sql", "SELECT country, count(*) AS n, max(close) AS top FROM px_prices WHERE close > 1000 GROUP BY country")(_store_sql)
query("table_refresh", "SELECT * FROM prices_clean")(_refresh)
query("stream_ingest", f"SELECT {_PRICES.replace(' close,', '')}, CASE WHEN date >= DATE '1998-01-01' THEN close + 1 ELSE close END AS close FROM px_prices")(_ingest)

query("incremental_refresh", "SELECT * FROM labelled")(lambda d: _updated(d).read("bankruptcy_dataset"))
query("catalog_schemas", "SELECT 'dividends' AS table_name, unnest(['ticker', 'dividend_date', 'country', 'dividend_amount']) AS column_name, unnest(['string', 'date', 'string', 'double']) AS type")(_schemas)
query("store_filtered", f"SELECT {_PRICES} FROM px_prices WHERE country = 'US' AND date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND ticker IN ('T1', 'T2', 'T3')")(_store_filtered)

# ---- landing
_TAGS = {"Revenues": "SalesRevenueNet", "OperatingCashFlow": "NetCashProvidedByUsedInOperatingActivities", "RetainedEarnings": "RetainedEarningsAccumulatedDeficit", "CapitalExpenditures": "PaymentsToAcquireProductiveAssets"}


def company_facts(d: Data) -> DataFrame:
    """Company-facts JSON of each ticker, made of its facts; every fifth fact is in a unit that is not allowed."""
    tag = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in _TAGS.items() for x in kv]), F.col("concept")), F.col("concept"))
    text = lambda c: F.col(c).cast("string")
    fact = F.struct(text("start_date").alias("start"), text("end_date").alias("end"), F.col("value").alias("val"), "form", text("filing_date").alias("filed"), F.year("end_date").alias("fy"), F.concat(F.lit("Q"), F.quarter("end_date")).alias("fp"))
    rows = d.px("financials").select("ticker", tag.alias("tag"), F.when(F.col("fact_id") % 5 == 0, "EUR").otherwise("USD").alias("unit"), fact.alias("fact"))
    units = rows.groupBy("ticker", "tag", "unit").agg(F.collect_list("fact").alias("facts")).groupBy("ticker", "tag").agg(F.map_from_entries(F.collect_list(F.struct("unit", "facts"))).alias("units"))
    tags = units.groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct("tag", F.struct("units")))).alias("tags"))
    return tags.select("ticker", F.to_json(F.struct(F.create_map(F.lit("us-gaap"), F.col("tags")).alias("facts"))).alias("payload"))


query("companyfacts_flatten", "SELECT ticker, concept, unit, start_date, end_date, value, form, filing_date FROM px_financials WHERE fact_id % 5 <> 0")(lambda d: landing.companyfacts_flatten(company_facts(d)))


def _facts_pair(d: Data) -> tuple[DataFrame, DataFrame]:
    f = d.unique.select("ticker", "concept", "end_date", "value", "form", "filing_date", "fact_id")
    gone = lambda c: F.when(F.col("fact_id") % 2 == 0, F.col(c)).alias(c)
    return f.filter("fact_id % 3 <> 0").select("ticker", "concept", "end_date", "value", gone("form"), gone("filing_date")), f.filter("fact_id % 3 <> 1").drop("fact_id")


query("merge_facts", "SELECT ticker, concept, end_date, value, CASE WHEN fact_id % 3 = 1 AND fact_id % 2 = 1 THEN NULL ELSE form END AS form, CASE WHEN fact_id % 3 = 1 AND fact_id % 2 = 1 THEN NULL ELSE filing_date END AS filing_date FROM facts_unique")(lambda d: landing.merge_facts(*_facts_pair(d)))


def share_payloads(d: Data) -> DataFrame:
    """Share-count JSON; tickers by number use the first, the second or the third tag of the chain, some none."""
    n = F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    tag = F.when(n % 4 == 0, K.SHARE_TAGS_DEI[0]).when(n % 4 == 1, K.SHARE_TAGS_DEI[1]).when(n % 4 == 2, K.SHARE_TAGS_GAAP[0]).otherwise("SomethingElse")
    s = d.px("shares")
    fact = lambda v: F.struct(F.make_date("fiscal_year", F.lit(12), F.lit(31)).cast("string").alias("end"), v.cast("double").alias("val"), F.col("filing_date").cast("string").alias("filed"), F.col("fiscal_year").alias("fy"), F.col("fiscal_period").alias("fp"))
    both = s.select("ticker", tag.alias("tag"), fact(F.col("shares")).alias("fact")).unionByName(s.filter("fiscal_year < 1997").select("ticker", F.lit(K.SHARE_TAGS_GAAP[1]).alias("tag"), fact(F.col("shares") * 2).alias("fact")))
    tags = both.groupBy("ticker", "tag").agg(F.collect_list("fact").alias("f")).groupBy("ticker").agg(F.map_from_entries(F.collect_list(F.struct("tag", F.struct(F.create_map(F.lit("shares"), F.col("f")).alias("units"))))).alias("tags"))
    return tags.select("ticker", F.to_json(F.struct(F.create_map(F.lit("dei"), F.col("tags")).alias("facts"))).alias("payload"))


_NUM = "CAST(regexp_extract(ticker, '(\\d+)', 1) AS INT)"
query("share_history", f"SELECT ticker, make_date(fiscal_year, 12, 31) AS end_date, filing_date, fiscal_year, fiscal_period, CASE WHEN {_NUM} % 4 = 3 THEN shares * 2 ELSE shares END AS shares, CASE WHEN {_NUM} % 4 < 2 THEN 'SEC_DEI' ELSE 'SEC_GAAP' END AS source_type FROM px_shares WHERE {_NUM} % 4 < 3 OR fiscal_year < 1997")(lambda d: landing.share_history(share_payloads(d)))


def income_payloads(d: Data) -> DataFrame:
    """Net income and earnings per share (income over a round number of shares) of the same periods, in two currencies; some earnings are zero, some are followed by a zero."""
    f = d.unique.filter("concept = 'NetIncomeLoss'")
    part = lambda v: F.struct(F.col("end_date").cast("string").alias("end"), v.alias("val"), F.col("filing_date").cast("string").alias("filed"), F.year("end_date").alias("fy"), F.concat(F.lit("Q"), F.quarter("end_date")).alias("fp"))
    eps, zero = part(F.when(F.col("fact_id") % 7 == 0, 0.0).otherwise(F.lit(2.0))), part(F.lit(0.0))
    g = f.groupBy("ticker").agg(F.collect_list(part(F.col("value"))).alias("a"), F.flatten(F.collect_list(F.when(F.col("fact_id") % 11 == 0, F.array(eps, zero)).otherwise(F.array(eps)))).alias("b"), F.collect_list(part(F.col("value") * 3)).alias("c"))
    units = lambda u, x, v, y: F.struct(F.create_map(F.lit(u), F.col(x), F.lit(v), F.col(y)).alias("units"))
    tags = F.create_map(F.lit("ProfitLoss"), units("EUR", "c", "USD", "a"), F.lit("EarningsPerShareBasic"), units("USD/shares", "b", "EUR/shares", "c"))
    return g.select("ticker", F.to_json(F.struct(F.create_map(F.lit("us-gaap"), tags).alias("facts"))).alias("payload"))


_CALCULATED = "SELECT ticker, end_date, filing_date, CAST(year(end_date) AS INT) AS fiscal_year, 'Q' || CAST(quarter(end_date) AS VARCHAR) AS fiscal_period, CAST(trunc(abs(value / 2)) AS BIGINT) AS shares, 'Calculated' AS source_type FROM facts_unique WHERE concept = 'NetIncomeLoss' AND fact_id % 7 <> 0 AND fact_id % 11 <> 0"
query("calculated_shares", _CALCULATED)(lambda d: landing.calculated_shares(income_payloads(d)))
query("share_counts", f"SELECT ticker, make_date(fiscal_year, 12, 31) AS end_date, filing_date, fiscal_year, fiscal_period, shares, 'SEC_DEI' AS source_type FROM px_shares WHERE {_NUM} % 4 < 2 UNION ALL {_CALCULATED} AND ticker NOT IN (SELECT ticker FROM px_shares WHERE {_NUM} % 4 < 2)")(
    lambda d: landing.share_counts(share_payloads(d).filter(F.regexp_extract("ticker", r"(\d+)", 1).cast("int") % 4 < 2).unionByName(income_payloads(d)))
)
query("merge_shares", "SELECT ticker, filing_date, country, shares, fiscal_year, fiscal_period FROM px_shares")(lambda d: (lambda s: landing.merge_new(s.filter("fiscal_year < 1998"), s.filter("fiscal_year > 1995"), ["ticker", "filing_date", "country", "shares", "fiscal_year", "fiscal_period"]))(d.px("shares").select("ticker", "filing_date", "country", "shares", "fiscal_year", "fiscal_period")))
query("merge_dividends", "SELECT * FROM px_dividends")(lambda d: (lambda s: landing.merge_new(s.filter("dividend_amount < 0.06"), s.filter("dividend_amount > 0.03"), ["ticker", "dividend_date", "country", "dividend_amount"]))(d.px("dividends")))

_FORMS = {k: ", ".join(f"'{x}'" for x in v) for k, v in (("gone", K.DELISTING_FORMS), ("off", K.DEREGISTRATION_FORMS), ("own", K.FINANCIAL_FORMS))}
_STATUS = f"""
SELECT cik, CASE WHEN gone IS NOT NULL THEN 'DELISTED' WHEN off IS NOT NULL THEN 'DEREGISTERED' WHEN latest IS NULL OR date_diff('day', latest, {FILINGS_AS_OF}) > 540 THEN 'ZOMBIE' ELSE 'ACTIVE' END AS status,
       coalesce(gone, off) AS delisting_date, CASE WHEN gone IS NOT NULL THEN gone_form WHEN off IS NOT NULL THEN off_form END AS delisting_form, last_filing_date, last_financial_report_date
FROM (SELECT cik, {", ".join(f"arg_min(filing_date, pos) FILTER (form IN ({_FORMS[k]})) AS {k}, arg_min(form, pos) FILTER (form IN ({_FORMS[k]})) AS {k}_form" for k in ("gone", "off"))},
        max(filing_date) FILTER (form IN ({_FORMS["own"]})) AS latest, arg_min(filing_date, pos) AS last_filing_date, arg_min(filing_date, pos) FILTER (form IN ({_FORMS["own"]})) AS last_financial_report_date FROM px_filings GROUP BY cik)"""
query("filing_status", f"SELECT cik, status, delisting_date, delisting_form FROM ({_STATUS})")(lambda d: landing.filing_status(landing.submissions(d.px("filings")), FILINGS_DAY).select("cik", "status", "delisting_date", "delisting_form"))
query("status_table", _STATUS)(lambda d: landing.filing_status(landing.submissions(d.px("filings")), FILINGS_DAY))
query("status_counts", f"SELECT status, count(*) AS n FROM ({_STATUS}) GROUP BY status")(lambda d: landing.filing_status(landing.submissions(d.px("filings")), FILINGS_DAY).groupBy("status").agg(F.count("*").alias("n")))
query("filing_dates", f"SELECT cik, form AS form_type, report_date AS end_date, filing_date, 'A' || cik || '-' || pos AS accession_number FROM px_filings WHERE form IN ({_FORMS['own']}) AND report_date IS NOT NULL AND filing_date IS NOT NULL")(
    lambda d: landing.filing_dates(landing.submissions(d.px("filings").filter("pos < 20")), landing.older_files(d.px("filings").filter("pos >= 20")))
)
query("cik_normalize", "SELECT o_orderkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik FROM orders")(lambda d: d.table("orders").select("o_orderkey", landing.cik_of(F.concat(F.lit(" CIK-"), F.col("o_custkey").cast("string"), F.lit(" "))).alias("cik")))


def _companies(d: Data) -> DataFrame:
    sic = F.when(F.col("s_suppkey") % 7 == 0, 6021).when(F.col("s_suppkey") % 7 == 1, 6726).otherwise(F.lit(3500) + F.col("s_nationkey"))
    name = F.when(F.col("s_suppkey") % 11 == 0, F.concat("s_name", F.lit(" Index Fund"))).otherwise(F.col("s_name"))
    return d.table("supplier").select(F.col("s_suppkey").alias("cik"), name.alias("name"), sic.cast("int").alias("sic"), F.array(F.concat(F.lit(" t"), F.col("s_suppkey") % 40), F.concat(F.lit("S"), "s_suppkey")).alias("tickers"))


_EXCLUDED = "(s_suppkey % 7 IN (0, 1) OR s_suppkey % 11 = 0)"
query("company_universe", f"SELECT s_suppkey AS cik, {_EXCLUDED} AS is_excluded FROM supplier")(lambda d: landing.company_universe(_companies(d)).select("cik", "is_excluded"))
query("ticker_list", f"SELECT DISTINCT unnest(['T' || CAST(s_suppkey % 40 AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR)]) AS ticker FROM supplier WHERE NOT {_EXCLUDED}")(lambda d: landing.ticker_list(_companies(d)))
_TICKERS = f"SELECT s_suppkey AS cik, unnest(['T' || CAST(s_suppkey % 40 AS VARCHAR), 'S' || CAST(s_suppkey AS VARCHAR)]) AS ticker FROM supplier WHERE NOT {_EXCLUDED}"
query("ticker_ciks", f"SELECT ticker, max(cik) AS cik FROM ({_TICKERS}) GROUP BY 1")(lambda d: landing.ticker_ciks(_companies(d)))
query("primary_tickers", f"SELECT s_suppkey AS cik, 'T' || CAST(s_suppkey % 40 AS VARCHAR) AS ticker FROM supplier WHERE NOT {_EXCLUDED}")(lambda d: landing.primary_tickers(_companies(d)))


def _grid(d: Data) -> DataFrame:
    """Prices of six tickers as one row per date with a column per ticker and field."""
    p = d.px("prices").filter(F.col("ticker").isin("T1", "T2", "T3", "T4", "T5.PL", "T6")).withColumn("ticker", F.regexp_replace("ticker", r"\.PL$", ".WA"))
    cells = p.select("date", "ticker", F.explode(F.create_map(F.lit("high"), F.col("high"), F.lit("low"), F.col("low"))).alias("field", "value"))
    names = [f"{t}|{f}" for t in ("T1", "T2", "T3", "T4", "T5.WA", "T6") for f in ("high", "low")]
    return cells.withColumn("cell", F.concat_ws("|", "ticker", "field")).groupBy("date").pivot("cell", names).agg(F.first("value"))


query("ohlcv_long", "SELECT date, ticker, high, low, country FROM px_prices WHERE ticker IN ('T1', 'T2', 'T3', 'T4', 'T5.PL', 'T6') AND (high IS NOT NULL OR low IS NOT NULL)")(lambda d: landing.ohlcv_long(_grid(d), ["high", "low"]))
_UNIVERSE = "SELECT DISTINCT 'T' || CAST(s_suppkey % 50 AS VARCHAR) AS ticker FROM supplier"
_universe = lambda d: d.table("supplier").select(F.concat(F.lit("T"), (F.col("s_suppkey") % 50).cast("string")).alias("ticker")).distinct()
_MARKS = f"SELECT u.ticker, coalesce(CAST(max(p.dividend_date) - INTERVAL 7 DAY AS DATE), DATE '1990-01-01') AS start_date FROM ({_UNIVERSE}) u LEFT JOIN px_dividends p ON u.ticker = p.ticker GROUP BY u.ticker"
_marks = lambda d: landing.high_water_marks(_universe(d), d.px("dividends"), "dividend_date", 7, datetime.date(1990, 1, 1))
query("high_water_mark", _MARKS)(_marks)
query("fetch_groups", f"SELECT start_date, count(*) AS n_tickers, string_agg(ticker, ',' ORDER BY ticker) AS tickers FROM ({_MARKS}) GROUP BY start_date")(lambda d: landing.by_start(_marks(d)))
query("covered_delisted", "SELECT DISTINCT ticker FROM px_prices WHERE ticker NOT IN (SELECT s.ticker FROM px_status s JOIN (SELECT ticker, max(date) AS last FROM px_prices GROUP BY 1) p ON s.ticker = p.ticker WHERE s.status IN ('DELISTED', 'DEREGISTERED') AND p.last >= s.delisting_date)")(lambda d: landing.covered_delisted(d.px("prices"), d.px("prices"), d.px("status")))
query("new_facts", "SELECT fact_id FROM facts_unique f WHERE NOT EXISTS (SELECT 1 FROM facts_unique g WHERE g.fact_id % 3 = 0 AND g.ticker = f.ticker AND g.end_date = f.end_date AND g.value = f.value)")(lambda d: landing.new_facts(d.unique.filter("fact_id % 3 = 0"), d.unique).select("fact_id"))
query("series_merge", "SELECT date, CASE WHEN date >= DATE '1997-01-01' THEN inflation_usa + 1 ELSE inflation_usa END AS value, date >= DATE '1999-01-01' AS is_new FROM px_macro WHERE inflation_usa IS NOT NULL")(
    lambda d: (lambda m: landing.merge_series(m.filter("date < '1999-01-01'"), m.filter("date >= '1997-01-01'").withColumn("value", F.col("value") + 1)))(d.px("macro").select("date", F.col("inflation_usa").alias("value")).filter("value is not null"))
)


def _jsonstat(d: Data) -> DataFrame:
    m = d.px("macro").select(F.date_format("date", "yyyy-MM").alias("p"), F.col("inflation_pl").alias("v"), (F.months_between("date", F.lit("1990-01-01"))).cast("int").alias("i"))
    g = m.agg(F.map_from_entries(F.collect_list(F.when(F.col("v").isNotNull(), F.struct(F.col("i").cast("string"), "v")))).alias("values"), F.map_from_entries(F.collect_list(F.struct("p", "i"))).alias("index"))
    return g.select(F.lit("hicp").alias("series"), F.to_json(F.struct(F.col("values").alias("value"), F.struct(F.struct(F.struct(F.col("index").alias("index")).alias("category")).alias("time")).alias("dimension"))).alias("payload"))


query("jsonstat", "SELECT 'hicp' AS series, date, inflation_pl AS value FROM px_macro WHERE inflation_pl IS NOT NULL")(lambda d: landing.jsonstat(_jsonstat(d)))


def _pages(d: Data) -> DataFrame:
    """Report pages: three labelled rows and one that is not known, a column per quarter, numbers in thousands with blanks and commas."""
    f = d.px("financials").filter("country = 'PL'").groupBy("ticker", "end_date").agg(F.max("value").alias("v")).filter(F.month("end_date").isin(3, 6, 9, 12))
    name = F.element_at(F.create_map(*[F.lit(x) for kv in {3: "mar", 6: "cze", 9: "wrz", 12: "gru"}.items() for x in kv]), F.month("end_date"))
    head = F.format_string("<th>%d/Q%d(%s %s)</th>", F.year("end_date"), F.quarter("end_date"), name, F.date_format("end_date", "yy"))
    whole = F.floor("v").cast("long").cast("string")
    number = F.regexp_replace(whole, r"(\d)(?=(\d{3})+$)", "$1 ")
    g = f.groupBy("ticker").agg(F.sort_array(F.collect_list(F.struct("end_date", head.alias("h"), number.alias("n")))).alias("c"))
    cells = lambda k, a="<td>", b="</td>": F.array_join(F.transform("c", lambda x: F.concat(F.lit(a), x[k], F.lit(b))), "")
    row = lambda label: F.concat(F.lit(f"<tr><td><b>{label}</b></td>"), cells("n"), F.lit("</tr>"))
    return g.select("ticker", F.concat(F.lit('<html><table class="report-table"><tr><th></th>'), cells("h", "", ""), F.lit("</tr>"), row("Przychody ze sprzedaży"), row("Nieznane"), row("Zysk netto"), F.lit("</table></html>")).alias("html"))


query("report_page_facts", "SELECT ticker, concept, 'PLN' AS unit, end_date, 'Q' || CAST(quarter(end_date) AS VARCHAR) AS report_type, v * 1000 AS value FROM (SELECT ticker, end_date, floor(max(value)) AS v FROM px_financials WHERE country = 'PL' GROUP BY 1, 2) CROSS JOIN (SELECT unnest(['Revenues', 'NetIncomeLoss']) AS concept) WHERE month(end_date) IN (3, 6, 9, 12)")(lambda d: landing.report_page_facts(_pages(d), K.INCOME_LABELS))
query("period_header", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) || '-12-31' WHEN 1 THEN CAST(year(o_orderdate) AS VARCHAR) || '-09-30' END AS end_date, CASE o_orderkey % 3 WHEN 0 THEN 'Annual' WHEN 1 THEN 'Q3' END AS report_type FROM orders")(
    lambda d: d.table("orders").select("o_orderkey", landing.period_header(F.when(F.col("o_orderkey") % 3 == 0, F.format_string("%d (gru %s)", F.year("o_orderdate"), F.date_format("o_orderdate", "yy"))).when(F.col("o_orderkey") % 3 == 1, F.format_string("%d/Q3(wrz %s)", F.year("o_orderdate"), F.date_format("o_orderdate", "yy"))).otherwise("none")).alias("h")).select("o_orderkey", "h.end_date", "h.report_type")
)
query("local_number", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) * 1000 END AS value FROM orders")(
    lambda d: d.table("orders").select("o_orderkey", landing.local_number(F.when(F.col("o_orderkey") % 4 == 0, "-").when(F.col("o_orderkey") % 4 == 1, F.concat(F.col("o_custkey").cast("string"), F.lit(",0 tys. PLN"))).otherwise(F.regexp_replace(F.col("o_custkey").cast("string"), r"(\d)(?=(\d{3})+$)", "$1 "))).alias("value"))
)
query("link_extract", "SELECT page_id, nullif(trim(regexp_extract(html, '<a[^>]*href=\"/[^\"]*\"[^>]*>([^<]+)', 1)), '') AS link_text FROM pages")(lambda d: d.table("pages").select("page_id", landing.link_text(F.col("html"), "/").alias("link_text")))

# ---- clean
query("prices_clean", "SELECT * FROM prices_clean")(lambda d: d.prices)
query("nearest_filing", "SELECT * FROM nearest")(lambda d: cleaning.nearest_filing(d.unique))
query("facts_filled", "SELECT * FROM facts_filled")(lambda d: d.filled.select("ticker", "concept", "country", "unit", "start_date", "end_date", "value", "value_source", "form", "filing_date"))
query("ytd_to_discrete", "SELECT ticker, concept, end_date, value_quarterly, value_quarterly_source FROM facts_clean")(lambda d: d.clean.select("ticker", "concept", "end_date", "value_quarterly", "value_quarterly_source"))
query("period_length", "SELECT ticker, concept, end_date, period_type, period_length_months FROM facts_clean")(lambda d: d.clean.select("ticker", "concept", "end_date", "period_type", "period_length_months"))
query("fiscal_quarter", "SELECT ticker, concept, end_date, fiscal_quarter FROM facts_clean")(lambda d: d.clean.select("ticker", "concept", "end_date", "fiscal_quarter"))
query("year_complete", "SELECT ticker, concept, end_date, quarters_available, year_complete FROM facts_clean")(lambda d: d.clean.select("ticker", "concept", "end_date", "quarters_available", "year_complete"))
query("period_distribution", "SELECT period_type, fiscal_quarter, count(*) AS n FROM facts_clean GROUP BY 1, 2")(lambda d: cleaning.period_distribution(d.clean))
query("mixed_quarters", "SELECT ticker, end_date, count(DISTINCT fiscal_quarter) AS distinct_quarters, string_agg(DISTINCT fiscal_quarter, ', ' ORDER BY fiscal_quarter) AS quarters FROM facts_clean GROUP BY 1, 2 HAVING count(DISTINCT fiscal_quarter) > 1 ORDER BY ticker, end_date LIMIT 10")(lambda d: cleaning.mixed_quarters(d.clean))
query("flow_quarter", "SELECT * FROM flows")(lambda d: cleaning.flow_quarter(d.clean))
query("snapshot_to_flow", "SELECT * FROM snapshot_flow")(lambda d: cleaning.snapshot_to_flow(d.clean))
query("facts_redated", "SELECT ticker, country, concept, end_date, period_type, fiscal_quarter, value_quarterly, filing_date FROM facts_redated")(lambda d: cleaning.redate(d.clean).select("ticker", "country", "concept", "end_date", "period_type", "fiscal_quarter", "value_quarterly", "filing_date"))
query("financials_wide", "SELECT * FROM fin_wide")(lambda d: d.wide)
query("dividends_clean", "SELECT * FROM dividends_clean")(lambda d: cleaning.clean_dividends(d.px("dividends")))
query("sectors_clean", "SELECT * FROM sectors_clean")(lambda d: cleaning.clean_sectors(d.px("sectors")))
query("shares_clean", "SELECT ticker, filing_date, country, shares, end_date, fiscal_year, fiscal_period, source_type FROM shares_clean")(lambda d: cleaning.clean_shares(d.px("shares")))
query("macro_yoy", "SELECT date, (inflation_usa / nullif(lag(inflation_usa, 12) OVER w, 0) - 1) * 100 AS inflation_usa_yoy, inflation_usa - lag(inflation_usa) OVER w AS inflation_usa_diff FROM px_macro WINDOW w AS (ORDER BY date)")(lambda d: cleaning.macro_changes(d.px("macro").select("date", "inflation_usa")))
query("macro_normalized", "SELECT * FROM macro_norm")(lambda d: cleaning.normalize_macro(d.px("macro")))

# ---- master
_FIN = ["Assets", "Revenues", "NetIncomeLoss", "StockholdersEquity"]
query("publication_month", "SELECT ticker, end_date, fiscal_quarter, CAST(date_trunc('month', CAST(coalesce(filing_date, end_date) + INTERVAL 1 DAY AS DATE)) + INTERVAL 1 MONTH AS DATE) AS publication_date FROM fin_wide")(lambda d: d.wide.select("ticker", "end_date", "fiscal_quarter", master.publication_date(F.coalesce("filing_date", "end_date")).alias("publication_date")))
query("publication_filter", "SELECT ticker, country, end_date, filing_date, publication_date FROM published")(lambda d: master.published(d.wide, AS_OF).select("ticker", "country", "end_date", "filing_date", "publication_date"))
query("publication_dedup", "SELECT ticker, country, end_date, fiscal_quarter, publication_date, Assets, Revenues FROM reports")(lambda d: d.reports.select("ticker", "country", "end_date", "fiscal_quarter", "publication_date", "Assets", "Revenues"))
query("monthly_spine", "SELECT * FROM spine")(lambda d: master.monthly_spine(d.reports))
query("asof_backward", "SELECT s.ticker, s.country, s.date, r.publication_date, r.end_date FROM spine s ASOF LEFT JOIN reports r ON s.ticker = r.ticker AND s.country = r.country AND s.date >= r.publication_date")(
    lambda d: asof.asof_join(master.monthly_spine(d.reports), d.reports.select("ticker", "country", "publication_date", "end_date"), ["ticker", "country"], "date", "publication_date", plan="window").select("ticker", "country", "date", "_match.publication_date", "_match.end_date")
)
query("asof_stale_cut", f"SELECT ticker, country, date, end_date, filing_date, fiscal_quarter, {', '.join(_FIN)} FROM carried")(lambda d: d.carried.select("ticker", "country", "date", "end_date", "filing_date", "fiscal_quarter", *_FIN))
query("spine_prices_sectors", "SELECT ticker, country, date, high, low, close, sector, industry FROM priced")(lambda d: master.with_prices_sectors(d.carried, d.prices, cleaning.clean_sectors(d.px("sectors"))).select("ticker", "country", "date", "high", "low", "close", "sector", "industry"))
query("asof_shares", "SELECT ticker, country, date, shares_outstanding FROM shared")(lambda d: master.with_shares(master.monthly_spine(d.reports), cleaning.clean_shares(d.px("shares"))).select("ticker", "country", "date", "shares_outstanding"))
query("asof_macro", f"SELECT ticker, country, date, {', '.join(K.MACRO)} FROM known")(lambda d: master.with_macro(master.monthly_spine(d.reports), cleaning.normalize_macro(d.px("macro"))))
query("dividends_monthly", "SELECT * FROM dividends_month")(lambda d: master.monthly_dividends(cleaning.clean_dividends(d.px("dividends"))))
query("ratios", f"SELECT ticker, country, date, {', '.join(RATIOS)} FROM rated")(lambda d: master.with_ratios(d.known).select("ticker", "country", "date", *RATIOS))
query("ttm", f"SELECT ticker, country, date, {', '.join(TTM)} FROM summed")(lambda d: master.with_ttm(master.with_ratios(d.known)).select("ticker", "country", "date", *TTM))
query("lag12", "SELECT ticker, country, date, revenues_12m_ago, net_income_12m_ago FROM summed")(lambda d: master.with_lag12(d.known).select("ticker", "country", "date", "revenues_12m_ago", "net_income_12m_ago"))
query("growth", "SELECT ticker, country, date, revenue_growth, net_income_growth FROM grown")(lambda d: master.with_growth(master.with_lag12(d.known)).select("ticker", "country", "date", "revenue_growth", "net_income_growth"))
query("master_dataset", f"SELECT {MASTER_COLUMNS} FROM master")(lambda d: d.master)
query("master_coverage", f"SELECT count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers, count(DISTINCT date) AS n_dates, min(date) AS min_date, max(date) AS max_date, {', '.join(f'count({c}) AS with_{c}' for c in ('Assets', 'Revenues', 'NetIncomeLoss', 'close', 'shares_outstanding', 'sector'))} FROM master")(lambda d: master.coverage(d.master))

# ---- labels
_PROFILE = ["pct_negative_equity", "pct_negative_income", "pct_negative_ocf", "avg_debt_ratio", "avg_current_ratio", "avg_altman_partial"]
query("censor_delisted", "SELECT ticker, date, status, delisting_date FROM censored")(lambda d: d.censored.select("ticker", "date", "status", "delisting_date"))
query("distress_profile", f"SELECT ticker, ever_negative_equity, {_r(6, *_PROFILE)} FROM profile")(lambda d: rounded(labels.distress_profile(d.censored), 6, *_PROFILE))
query("distress_votes", "SELECT * FROM votes")(lambda d: labels.distress_votes(labels.distress_profile(d.censored)))
query("bankruptcy_target", "SELECT ticker, date, target_bankruptcy FROM targeted")(lambda d: labels.with_target(d.censored, labels.distress_votes(labels.distress_profile(d.censored))).select("ticker", "date", "target_bankruptcy"))
query("bankruptcy_dataset", "SELECT * FROM labelled")(lambda d: d.labelled)
query("bankruptcy_no_status", f"SELECT {MASTER_COLUMNS}, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS DATE) AS delisting_date, 0 AS target_bankruptcy FROM master")(lambda d: labels.build(d.master, None))
query("label_stats", "SELECT count(DISTINCT ticker) AS unique_tickers, count(DISTINCT date) AS unique_dates, min(date) AS min_date, max(date) AS max_date, CAST(sum(target_bankruptcy) AS BIGINT) AS bankrupt_rows, count(*) FILTER (target_bankruptcy = 0) AS active_rows, count(*) AS total_rows FROM labelled")(lambda d: labels.label_stats(d.labelled))
query("status_breakdown", "SELECT status, count(DISTINCT ticker) AS unique_tickers, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date FROM labelled WHERE status IS NOT NULL GROUP BY status")(lambda d: labels.status_breakdown(d.labelled))
query("recent_delistings", "SELECT ticker, status, delisting_date, max(date) AS last_data_date, count(*) AS total_rows FROM labelled WHERE status IN ('DELISTED', 'DEREGISTERED') GROUP BY 1, 2, 3 ORDER BY delisting_date DESC NULLS LAST, ticker LIMIT 10")(lambda d: labels.recent_delistings(d.labelled))

# ---- features
_X = {"altman_x1": "(AssetsCurrent - LiabilitiesCurrent) / nullif(Assets, 0)", "altman_x2": "RetainedEarnings / nullif(Assets, 0)", "altman_x3": "OperatingIncomeLoss / nullif(Assets, 0)", "altman_x4": "close * shares_outstanding / nullif(Liabilities, 0)", "altman_x5": "Revenues / nullif(Assets, 0)"}
_ALTMAN = f"SELECT *, 1.2::DOUBLE * altman_x1 + 1.4::DOUBLE * altman_x2 + 3.3::DOUBLE * altman_x3 + 0.6::DOUBLE * altman_x4 + 1.0::DOUBLE * altman_x5 AS altman_z_approx FROM (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _X.items())} FROM labelled)"
_FLAGS = {"negative_equity": "StockholdersEquity < 0", "negative_income": "NetIncomeLoss < 0", "negative_ocf": "OperatingCashFlow < 0", "revenue_decline": "revenue_growth < 0", "high_leverage": "debt_to_equity > 2.0", "low_liquidity": "current_ratio < 1.0"}
_FLAG_SQL = ", ".join(f"CAST(coalesce({v}, false) AS INT) AS {k}" for k, v in _FLAGS.items())
_SCORE_SQL = " + ".join(f"CAST(coalesce({v}, false) AS INT)" for v in _FLAGS.values())
_TREND = [f"{c}_{k}{n}" for n in (3, 6, 12) for c in features.TREND for k in ("ma", "std")]
_TREND_SQL = ", ".join(f"round(avg({c}) OVER w{n}, 4) AS {c}_ma{n}, round(stddev_samp({c}) OVER w{n}, 4) AS {c}_std{n}" for n in (3, 6, 12) for c in features.TREND)
_WINDOWS = ", ".join(f"w{n} AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in (3, 6, 12))
_LAG_SQL = ", ".join(f"lag({c}, {n}) OVER w AS {c}_lag{n}" for c in features.LAGGED for n in (1, 3, 6))
_LAGS = [f"{c}_lag{n}" for c in features.LAGGED for n in (1, 3, 6)]
query("altman", f"SELECT ticker, date, {', '.join(_X)}, round(altman_z_approx, 4) AS altman_z_approx FROM ({_ALTMAN})")(lambda d: rounded(features.altman(d.labelled).select("ticker", "date", *_X, "altman_z_approx"), 4, "altman_z_approx"))
query("distress_flags", f"SELECT ticker, date, {_FLAG_SQL}, {_SCORE_SQL} AS distress_score FROM labelled")(lambda d: features.distress_flags(d.labelled).select("ticker", "date", *_FLAGS, "distress_score"))
query("rolling_trends", f"SELECT ticker, date, {_TREND_SQL} FROM labelled WINDOW {_WINDOWS}")(lambda d: rounded(features.trends(d.labelled).select("ticker", "date", *_TREND), 4, *_TREND))
query("feature_lags", f"SELECT ticker, date, {_LAG_SQL} FROM labelled WINDOW w AS (PARTITION BY ticker ORDER BY date)")(lambda d: features.lags(d.labelled).select("ticker", "date", *_LAGS))
query("feature_pipeline", f"SELECT ticker, date, round(altman_z_approx, 4) AS altman_z_approx, {_SCORE_SQL} AS distress_score, round(avg(roe) OVER w3, 4) AS roe_ma3, lag(close, 1) OVER w AS close_lag1 FROM ({_ALTMAN}) WINDOW {_WINDOWS}, w AS (PARTITION BY ticker ORDER BY date)")(lambda d: rounded(features.pipeline(d.labelled).select("ticker", "date", "altman_z_approx", "distress_score", "roe_ma3", "close_lag1"), 4, "altman_z_approx", "roe_ma3"))
_NUMERIC = [c for c in master.columns() if c not in features.EXCLUDED]


def _prepared_sql(rows: str, by: str) -> str:
    """(ticker, date, column, value) of ``rows`` with the columns and medians that the rows of ``by`` give."""
    cells = lambda t: " UNION ALL ".join(f"SELECT ticker, date, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM {t}" for c in _NUMERIC)
    return f"""SELECT c.ticker, c.date, c."column", round(coalesce(c.value, m.middle), 6) AS value FROM ({cells(rows)}) c JOIN (SELECT f."column", any_value(middle) AS middle FROM ({cells(by)}) f JOIN (
      SELECT "column", quantile_cont(value, 0.5) AS middle FROM ({cells(by)}) GROUP BY 1 HAVING 1 - count(value) / CAST(count(*) AS DOUBLE) < 0.9) q ON f."column" = q."column" GROUP BY 1 HAVING var_samp(coalesce(value, middle)) > 0) m ON c."column" = m."column\""""


def _in_long(df: DataFrame, *keys: str) -> DataFrame:
    columns = [c for c in df.columns if c not in ("ticker", "date", "target_bankruptcy", "split")]
    return rounded(long(df, columns, "ticker", "date", *keys), 6, "value")


query("prepare_features", _prepared_sql("labelled", "labelled"))(lambda d: _in_long(features.prepare(d.labelled).apply(d.labelled)))
_CUT = "SELECT *, CASE WHEN date >= (SELECT date FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM labelled)) WHERE i = floor(n * (1 - 0.2::DOUBLE))) THEN 'test' ELSE 'train' END AS split FROM labelled"
query("time_split", f"SELECT ticker, date, split FROM ({_CUT})")(lambda d: features.time_split(d.labelled).select("ticker", "date", "split"))
query("aligned_split", f"SELECT g.*, split FROM ({_prepared_sql('sides', 'train_side')}) g JOIN sides USING (ticker, date)", sides=_CUT, train_side="SELECT * FROM sides WHERE split = 'train'")(lambda d: _in_long(features.aligned_split(d.labelled), "split"))
_SEL = ["roa", "debt_ratio", "asset_turnover", "close"]
_FULL = f"SELECT target_bankruptcy AS y, {', '.join(_SEL)} FROM labelled WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _SEL)}"
_LONG = " UNION ALL ".join(f"SELECT y, '{c}' AS feature, {c} AS x FROM sel" for c in _SEL)
query("select_f", "SELECT feature, round((b / (k - 1)) / (w / (n - k)), 4) AS score FROM (SELECT feature, sum(n * (m - g) * (m - g)) AS b, sum(n * v) AS w, count(*) AS k, sum(n) AS n FROM (SELECT *, sum(n * m) OVER (PARTITION BY feature) / sum(n) OVER (PARTITION BY feature) AS g FROM (SELECT feature, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM sel_long GROUP BY 1, 2)) GROUP BY feature)", sel=_FULL, sel_long=_LONG)(lambda d: rounded(features.select_f(d.labelled, _SEL), 4, "score"))
query("select_chi2", "SELECT feature, round(sum((o - e) * (o - e) / nullif(e, 0)), 4) AS score FROM (SELECT *, sum(o) OVER (PARTITION BY feature) * n / sum(n) OVER (PARTITION BY feature) AS e FROM (SELECT *, s - n * min(lo) OVER (PARTITION BY feature) AS o FROM (SELECT feature, y, count(*) AS n, sum(x) AS s, min(x) AS lo FROM sel_long GROUP BY 1, 2))) GROUP BY feature", sel=_FULL, sel_long=_LONG)(lambda d: rounded(features.select_chi2(d.labelled, _SEL), 4, "score"))
_PSI = lambda x: f"(ln({x} + 10) - 1 / (2 * ({x} + 10.0::DOUBLE)) - 1 / (12 * ({x} + 10.0::DOUBLE) ^ 2) + 1 / (120 * ({x} + 10.0::DOUBLE) ^ 4) - 1 / (252 * ({x} + 10.0::DOUBLE) ^ 6) - {' - '.join(f'1 / ({x} + {i}.0::DOUBLE)' for i in range(10))})"
_NEAR = {
    "points": "SELECT row_number() OVER () AS i, feature, y, x FROM sel_long", "classes": "SELECT feature, y, count(*) AS ny FROM points GROUP BY 1, 2 HAVING count(*) > 1",
    "reach": "SELECT a.i, a.feature, any_value(a.x) AS x, any_value(ny) AS ny, least(3, any_value(ny) - 1) AS k, list_sort(list(abs(b.x - a.x)))[least(3, any_value(ny) - 1)] AS r FROM points a JOIN points b ON a.feature = b.feature AND a.y = b.y AND a.i <> b.i JOIN classes c ON a.feature = c.feature AND a.y = c.y GROUP BY 1, 2",
    "nearer": "SELECT a.i, a.feature, any_value(ny) AS ny, any_value(k) AS k, count(*) FILTER (abs(b.x - a.x) < r OR b.x = a.x) AS m FROM reach a JOIN (SELECT p.* FROM points p JOIN classes c ON p.feature = c.feature AND p.y = c.y) b ON a.feature = b.feature GROUP BY 1, 2",
}
query("select_mi", f"SELECT feature, round(greatest({_PSI('count(*)')} + avg({_PSI('k')}) - avg({_PSI('ny')}) - avg({_PSI('m')}), 0), 6) AS score FROM nearer GROUP BY feature", sel=_FULL, sel_long=_LONG, **_NEAR)(lambda d: rounded(features.top_features(features.select_mi(d.labelled, _SEL), 20), 6, "score"))


def _mi_prepared(d: Data) -> DataFrame:
    """All prepared features."""
    fitted = features.prepare(d.labelled)
    return features.select_mi(d._stage("prepared", lambda: fitted.apply(d.labelled)), fitted.columns)


query("select_mi_prepared")(_mi_prepared)
query("random_split", "SELECT ticker, date, CASE WHEN md5('42|' || ticker || '|' || CAST(date AS VARCHAR)) < '33333333' THEN 'test' ELSE 'train' END AS split FROM labelled")(lambda d: features.random_split(d.labelled).select("ticker", "date", "split"))
_FOLDS = "SELECT fold, min(date) AS a, max(date) AS b FROM (SELECT date, CAST(floor(i * 6 / n) AS BIGINT) AS fold FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT date FROM labelled))) WHERE fold > 0 GROUP BY fold"
query("walk_forward", "SELECT ticker, date, fold, CASE WHEN date >= a THEN 'test' ELSE 'train' END AS side FROM labelled JOIN date_folds ON date BETWEEN a AND b OR date <= CAST(a - INTERVAL 12 MONTH AS DATE)", date_folds=_FOLDS)(lambda d: features.walk_forward(d.labelled).select("ticker", "date", "fold", "side"))


# ---- models, with the builders' full settings
def _sides(d: Data) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the time split, made into training data by the training side."""
    split = d._stage("split", lambda: features.aligned_split(d.labelled))
    columns = [c for c in split.columns if c not in ("ticker", "date", "target_bankruptcy", "split")]
    side = lambda x: split.filter(F.col("split") == x).drop("split")
    return side("train"), side("test"), columns


def _logistic(train: DataFrame, columns: list[str]):
    return models.logistic(columns, train.count())


def _scored(d: Data, build: Callable[[DataFrame, list[str]], object]) -> DataFrame:
    train, test, columns = _sides(d)
    return models.score(models.train(build(train, columns), train), test).select("ticker", "date", "target_bankruptcy", "score")


query("rf")(lambda d: _scored(d, lambda t, c: models.random_forest(c)))
query("gbt")(lambda d: _scored(d, lambda t, c: models.boosted_trees(c)))
query("boosted", None)(lambda d: (lambda t: boosting.fit(t[0], t[2], "target_bankruptcy", s=boosting.Settings(rounds=BOOST_ROUNDS)).score(t[1]).select("ticker", "date", "target_bankruptcy", "score"))(_sides(d)))
query("logistic")(lambda d: _scored(d, _logistic))
query("calibrate")(lambda d: (lambda t: models.calibrate(models.random_forest(t[2]), t[0]).score(t[1]).select("ticker", "date", "target_bankruptcy", "score", "calibrated"))(_sides(d)))
query("importance")(lambda d: (lambda t: models.importance(d.spark, models.train(models.random_forest(t[2]), t[0]), t[2]))(_sides(d)))
query("compare_models")(lambda d: (lambda t: models.compare({"rf": models.random_forest(t[2]), "logistic": _logistic(t[0], t[2])}, t[0], t[1]))(_sides(d)))
query("cross_validate")(lambda d: (lambda t: models.cross_validate(models.random_forest(t[2]), t[0]))(_sides(d)))
# scores that are given: a rate of the table's own
_GIVEN = "SELECT target_bankruptcy AS y, debt_ratio / (1 + debt_ratio) AS s FROM labelled WHERE debt_ratio >= 0"


def _given(d: Data) -> DataFrame:
    return d.labelled.filter("debt_ratio >= 0").withColumn("score", F.col("debt_ratio") / (1 + F.col("debt_ratio")))


query("class_report", f"""SELECT label, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / nullif(p + r, 0), 6) AS f1, support FROM (SELECT label, 1.0 * hit / nullif(said, 0) AS p, 1.0 * hit / nullif(support, 0) AS r, support FROM (
  SELECT label, count(*) FILTER (y = label) AS support, count(*) FILTER (said = label) AS said, count(*) FILTER (y = label AND said = label) AS hit FROM (SELECT y, CAST(s >= 0.5 AS INT) AS said FROM ({_GIVEN})) CROSS JOIN (VALUES (0), (1)) l(label) GROUP BY label))""")(lambda d: rounded(models.report(_given(d)), 6, "precision", "recall", "f1"))
query("score_areas", f"""SELECT round(sum(CASE WHEN y = 1 THEN r END) / (p * (n - p)) - (p + 1) / (2.0 * (n - p)), 6) AS roc_auc, round(sum(CASE WHEN y = 1 THEN 1.0 * tp / above END) / p, 6) AS pr_auc, n, p AS positives
  FROM (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r, count(*) OVER (ORDER BY s DESC) AS above, sum(y) OVER (ORDER BY s DESC) AS tp, count(*) OVER () AS n, CAST(sum(y) OVER () AS BIGINT) AS p FROM ({_GIVEN})) GROUP BY n, p""")(lambda d: rounded(models.metrics(_given(d)), 6, "roc_auc", "pr_auc").select("roc_auc", "pr_auc", "n", "positives"))
query("isotonic_fit")(lambda d: isotonic.fit(_given(d).withColumn("y", F.col("target_bankruptcy").cast("double")), "score", "y").apply(_given(d), "score", "calibrated").select("ticker", "date", "score", "calibrated"))
query("validate_forward")(lambda d: (lambda t: models.validate_forward(models.random_forest(t[2], 50), t[0], 3))(_sides(d)))
query("threshold_search")(lambda d: models.best_threshold(_scored(d, lambda t, c: models.random_forest(c))))

# ---- statistics
_LONG_ALL = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM master" for c in stats.COLUMNS)
_PCT = {f"p{round(100 * p)}": p for p in stats.PERCENTILES}
_DESC = ["mean", "std", "min", "max", "missing_pct", "skewness", "kurtosis", "iqr", *_PCT]
query("describe", f"""SELECT "column", count(value) AS count, {_r(5, 'mean', 'std', 'min', 'max', 'missing_pct', 'skewness', 'kurtosis', 'iqr', *_PCT).replace('round(', 'round(any_value(').replace(', 5)', '), 5)')}, any_value(missing) AS missing, any_value(zeros) AS zeros, any_value(negatives) AS negatives FROM cells JOIN (
  SELECT "column" AS c2, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, count(*) FILTER (value IS NULL) AS missing, 100.0 * count(*) FILTER (value IS NULL) / count(*) AS missing_pct, count(*) FILTER (value = 0) AS zeros, count(*) FILTER (value < 0) AS negatives,
  skewness(value) AS skewness, CASE WHEN count(value) >= 4 THEN kurtosis(value) END AS kurtosis, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr, {', '.join(f'quantile_cont(value, {p}) AS {n}' for n, p in _PCT.items())} FROM cells GROUP BY 1) ON "column" = c2 GROUP BY 1""", cells=_LONG_ALL)(lambda d: rounded(stats.describe(d.master), 5, *_DESC))
query("describe_by_group", "SELECT sector, count(roa) AS count, round(avg(roa), 4) AS mean, round(stddev_samp(roa), 4) AS std, round(min(roa), 4) AS min, round(quantile_cont(roa, 0.25), 4) AS q25, round(median(roa), 4) AS median, round(quantile_cont(roa, 0.75), 4) AS q75, round(max(roa), 4) AS max, round(skewness(roa), 4) AS skewness FROM master GROUP BY sector")(lambda d: stats.describe_by_group(d.master, "sector", "roa"))
_MISSING = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, round(100.0 * (count(*) - count({c})) / count(*), 2) AS missing_pct, count({c}) AS present_count FROM master" for c in master.columns())
query("missing_report", f"SELECT * FROM ({_MISSING}) WHERE missing_pct >= 10")(lambda d: stats.missing_report(d.master, 10))
_GONE = " + ".join(f"(count(*) - count({c}))" for c in master.columns())
query("quality_summary", f"SELECT *, total_rows * 88 AS total_cells, round(100.0 * missing_cells / (total_rows * 88), 2) AS missing_pct, round(100 - 100.0 * missing_cells / (total_rows * 88), 2) AS completeness_pct FROM (SELECT count(*) AS total_rows, 88 AS total_columns, {_GONE} AS missing_cells, count(DISTINCT ticker) AS unique_tickers, count(DISTINCT sector) AS unique_sectors, min(date) AS first_date, max(date) AS last_date FROM master)")(lambda d: stats.quality_summary(d.master))
_OUT = {"cells": _LONG_ALL, "full": "SELECT * FROM cells WHERE value IS NOT NULL"}
query("outliers_iqr", 'SELECT f."column", count(*) AS total_values, count(*) FILTER (value < lo OR value > hi) AS outliers_count, round(any_value(lo), 6) AS lower_bound, round(any_value(hi), 6) AS upper_bound, round(100.0 * count(*) FILTER (value < lo OR value > hi) / count(*), 2) AS outliers_pct FROM full f JOIN (SELECT "column", q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM full GROUP BY 1)) b ON f."column" = b."column" GROUP BY 1'.replace("full", "filled_cells"), cells=_LONG_ALL, filled_cells=_OUT["full"])(lambda d: stats.outliers(d.master, digits=6))
query("outliers_z", 'SELECT f."column", count(*) AS total_values, count(*) FILTER (abs((value - m) / nullif(s, 0)) > 3) AS outliers_count, CAST(NULL AS DOUBLE) AS lower_bound, CAST(NULL AS DOUBLE) AS upper_bound, round(100.0 * count(*) FILTER (abs((value - m) / nullif(s, 0)) > 3) / count(*), 2) AS outliers_pct FROM filled_cells f JOIN (SELECT "column", avg(value) AS m, stddev_pop(value) AS s FROM filled_cells GROUP BY 1) b ON f."column" = b."column" GROUP BY 1', cells=_LONG_ALL, filled_cells=_OUT["full"])(lambda d: stats.outliers(d.master, method="zscore", threshold=3))
_CORR = ["roa", "ros", "debt_ratio", "asset_turnover", "close"]
_PAIR = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {a} AS x, {b} AS y FROM master WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for i, a in enumerate(_CORR) for b in _CORR[i + 1 :])
_ALL_PAIRS = [(a, b) for i, a in enumerate(stats.COLUMNS) for b in stats.COLUMNS[i + 1 :]]
_R = lambda a, b: f"CASE WHEN NOT isnan(corr({a}, {b})) THEN round(corr({a}, {b}), 6) END"
_ALL_R = f"SELECT unnest([{', '.join(repr(a) for a, _ in _ALL_PAIRS)}]) AS a, unnest([{', '.join(repr(b) for _, b in _ALL_PAIRS)}]) AS b, unnest([{', '.join(_R(a, b) for a, b in _ALL_PAIRS)}]) AS correlation FROM master"
query("corr_pearson", _ALL_R)(lambda d: rounded(stats.correlations(d.master, stats.COLUMNS), 6, "correlation"))
_FEW_PAIRS = ", ".join(f"('{a}', '{b}')" for i, a in enumerate(_CORR) for b in _CORR[i + 1 :])
_EVERY = lambda sql: f"SELECT e.a, e.b, correlation FROM (VALUES {_FEW_PAIRS}) e(a, b) LEFT JOIN ({sql}) g ON e.a = g.a AND e.b = g.b"
query("corr_spearman", _EVERY("SELECT a, b, round(corr(rx, ry), 6) AS correlation FROM (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY x) + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY a, b ORDER BY y) + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2.0 AS ry FROM pair_rows) GROUP BY 1, 2"), pair_rows=_PAIR)(lambda d: rounded(stats.correlations(d.master, _CORR, "spearman"), 6, "correlation"))
_TIES = lambda c: f"SELECT a, b, sum(n * (n - 1) / 2) AS t, sum(n) AS m FROM (SELECT a, b, count(*) AS n FROM pair_rows GROUP BY a, b, {c}) GROUP BY a, b"
query("corr_kendall", _EVERY(f"SELECT x.a, x.b, round(coalesce(s, 0) / nullif(sqrt((x.m * (x.m - 1) / 2 - x.t) * (x.m * (x.m - 1) / 2 - y.t)), 0), 6) AS correlation FROM ({_TIES('x')}) x JOIN ({_TIES('y')}) y ON x.a = y.a AND x.b = y.b LEFT JOIN (SELECT p.a, p.b, sum(sign(q.x - p.x) * sign(q.y - p.y)) AS s FROM pair_rows p JOIN pair_rows q ON p.a = q.a AND p.b = q.b AND q.x > p.x GROUP BY 1, 2) s ON x.a = s.a AND x.b = s.b"), pair_rows=_PAIR)(lambda d: rounded(stats.correlations(d.master, _CORR, "kendall"), 6, "correlation"))
_TARGET = [c for c in stats.COLUMNS if c != "revenue_growth"]
_TGT = f"SELECT unnest([{', '.join(map(repr, _TARGET))}]) AS variable, unnest([{', '.join(_R(c, 'revenue_growth') for c in _TARGET)}]) AS r FROM master"
query("corr_target", f"SELECT variable, round(r, 6) AS correlation, round(abs(r), 6) AS abs_correlation FROM ({_TGT})")(lambda d: rounded(stats.correlation_with(d.master, "revenue_growth"), 6, "correlation", "abs_correlation"))
query("corr_high", f"SELECT * FROM ({_ALL_R}) WHERE abs(correlation) >= 0.8")(lambda d: rounded(stats.high_correlations(d.master), 6, "correlation"))
query("corr_by_sector", "SELECT sector, round(corr(roa, debt_ratio), 6) AS correlation, count(*) AS n_samples FROM master WHERE roa IS NOT NULL AND debt_ratio IS NOT NULL AND sector IS NOT NULL GROUP BY sector HAVING count(*) >= 10")(lambda d: rounded(stats.correlation_by_sector(d.master, "roa", "debt_ratio"), 6, "correlation"))
_CLIP = "SELECT sector, CAST(close AS DOUBLE) AS value FROM master WHERE close IS NOT NULL AND close >= (SELECT quantile_cont(close, 0.01) FROM master) AND close <= (SELECT quantile_cont(close, 0.99) FROM master)"
query("histogram", "SELECT CAST(least(floor((value - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, count(*) AS n FROM clip, (SELECT min(value) AS lo, max(value) AS hi FROM clip) GROUP BY 1", clip=_CLIP)(lambda d: stats.histogram(d.master, "close", 20))
_TOP = "SELECT sector FROM master WHERE sector IS NOT NULL GROUP BY sector ORDER BY count(*) DESC, sector LIMIT 3"
_CLIP3 = "SELECT sector, close AS value FROM master WHERE sector IN (SELECT sector FROM top3) AND close IS NOT NULL AND close >= (SELECT quantile_cont(close, 0.01) FROM master WHERE sector IN (SELECT sector FROM top3)) AND close <= (SELECT quantile_cont(close, 0.99) FROM master WHERE sector IN (SELECT sector FROM top3))"
query("box_by_sector", "SELECT c.sector, any_value(n) AS n, round(any_value(mean), 4) AS mean, round(any_value(q25), 4) AS q25, round(any_value(med), 4) AS median, round(any_value(q75), 4) AS q75, min(value) FILTER (value >= q25 - 1.5 * (q75 - q25) AND value <= q75 + 1.5 * (q75 - q25)) AS whisker_low, max(value) FILTER (value >= q25 - 1.5 * (q75 - q25) AND value <= q75 + 1.5 * (q75 - q25)) AS whisker_high FROM clip c JOIN (SELECT sector, count(*) AS n, avg(value) AS mean, quantile_cont(value, 0.25) AS q25, median(value) AS med, quantile_cont(value, 0.75) AS q75 FROM clip GROUP BY 1) q ON c.sector = q.sector GROUP BY 1", top3=_TOP, clip=_CLIP3)(lambda d: rounded(stats.box_by_sector(d.master, "close", 3), 4, "mean", "q25", "median", "q75"))
_GRID = stats.COLUMNS[:12]
_GRID_LONG = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM master WHERE {c} IS NOT NULL" for c in _GRID)
_GRID_CLIP = 'SELECT g."column", value FROM grid g JOIN (SELECT "column", quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM grid GROUP BY 1) b ON g."column" = b."column" WHERE value >= lo AND value <= hi'
query("histogram_grid", 'SELECT g."column", CAST(coalesce(least(floor((value - lo) * 20 / nullif(hi - lo, 0)), 19), 0) AS BIGINT) AS bin, count(*) AS n FROM grid_clip g JOIN (SELECT "column", min(value) AS lo, max(value) AS hi FROM grid_clip GROUP BY 1) b ON g."column" = b."column" GROUP BY 1, 2', grid=_GRID_LONG, grid_clip=_GRID_CLIP)(lambda d: stats.histogram_grid(d.master, bins=20))
query("violin", f'SELECT "column", count(*) AS n, {", ".join(f"round({x}, 4) AS {n}" for n, x in (("mean", "avg(value)"), ("std", "stddev_samp(value)"), ("q25", "quantile_cont(value, 0.25)"), ("median", "median(value)"), ("q75", "quantile_cont(value, 0.75)")))} FROM grid_clip GROUP BY 1', grid=_GRID_LONG, grid_clip=_GRID_CLIP)(lambda d: rounded(stats.violin(d.master, _GRID), 4, "mean", "std", "q25", "median", "q75"))
query("price_history", "SELECT ticker, date, close FROM master WHERE ticker IN ('T1', 'T2', 'T5.PL')")(lambda d: stats.price_history(d.master, ["T1", "T2", "T5.PL"]))
_GROUP = ["roe", "roa", "ros", "gross_margin", "operating_margin"]
_HEAT = " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, " + (f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END" if a == b else f"round(corr({a}, {b}), 6)") + f" AS correlation, {str(j > i).lower()} AS masked FROM master" for i, a in enumerate(_GROUP) for j, b in enumerate(_GROUP))
query("heatmap_group", f"SELECT a, b, CAST(correlation AS DOUBLE) AS correlation, masked FROM ({_HEAT})")(lambda d: rounded(stats.heatmap(d.master, stats.group_columns(d.master, "profitability")), 6, "correlation"))
query("scaled_series", "SELECT ticker, date, (close - min(close) OVER w) / nullif(max(close) OVER w - min(close) OVER w, 0) AS value FROM master WHERE ticker IN ('T1', 'T2', 'T3') AND close IS NOT NULL WINDOW w AS (PARTITION BY ticker)")(lambda d: stats.scaled_series(d.master, ["T1", "T2", "T3"], "close"))
query("sector_composition", "SELECT sector, count(DISTINCT ticker) AS n_tickers FROM master WHERE sector IS NOT NULL GROUP BY sector ORDER BY n_tickers DESC, sector LIMIT 15")(lambda d: stats.sector_composition(d.master))
query("missing_bands", f"SELECT \"column\", missing_pct, CASE WHEN missing_pct > 50 THEN 'high' WHEN missing_pct > 20 THEN 'medium' ELSE 'low' END AS band FROM ({_MISSING}) ORDER BY missing_pct DESC, \"column\" LIMIT 30")(lambda d: stats.missing_bands(d.master))
query("scatter_fit", "SELECT count(*) AS n, round(regr_slope(roa, debt_ratio), 6) AS slope, round(regr_intercept(roa, debt_ratio), 6) AS intercept, round(corr(debt_ratio, roa), 6) AS r FROM master WHERE roa IS NOT NULL AND debt_ratio IS NOT NULL")(lambda d: rounded(stats.scatter_fit(d.master, "debt_ratio", "roa"), 6, "slope", "intercept", "r"))
_HUES = "SELECT sector FROM master WHERE sector IS NOT NULL GROUP BY sector ORDER BY count(*) DESC, sector LIMIT 10"
query("scatter_points", f"SELECT ticker, date, debt_ratio, roa, CASE WHEN sector IN ({_HUES}) THEN sector ELSE 'Other' END AS hue FROM (SELECT * FROM master WHERE debt_ratio IS NOT NULL AND roa IS NOT NULL ORDER BY md5(ticker || '|' || CAST(date AS VARCHAR)), ticker, date LIMIT 5000)")(lambda d: stats.scatter_points(d.master, "debt_ratio", "roa"))

# ---- screener
_OPS = {"<": "close < 20000", "<=": "close <= 20000", ">": "close > 20000", ">=": "close >= 20000", "==": "close = 20000", "!=": "close IS DISTINCT FROM 20000", "between": "close BETWEEN 10000 AND 30000", "in": "sector IN ('ASIA', 'AFRICA')", "not_in": "coalesce(sector NOT IN ('ASIA', 'AFRICA'), true)", "is_null": "close IS NULL", "not_null": "close IS NOT NULL"}


def _filter_ops(d: Data) -> DataFrame:
    def condition(op: str) -> screener.Condition:
        if op in ("in", "not_in"):
            return screener.Condition("sector", op, ["ASIA", "AFRICA"])
        return screener.Condition("close", op, 10000, 30000) if op == "between" else screener.Condition("close", op, 20000)

    return d.master.agg(*[F.count_if(condition(op).to_column()).alias(f"n{i}") for i, op in enumerate(_OPS)])


query("filter_ops", f"SELECT {', '.join(f'count(*) FILTER ({c}) AS n{i}' for i, c in enumerate(_OPS.values()))} FROM master")(_filter_ops)
query("latest_per_ticker", "SELECT ticker, date, close, sector FROM latest")(lambda d: screener.at_date(d.master).select("ticker", "date", "close", "sector"))
_SHOW = ", ".join(screener.DISPLAY)
query("scan", f"SELECT {_SHOW} FROM latest WHERE country = 'US' AND close > 10000 ORDER BY close DESC, ticker LIMIT 20")(lambda d: screener.scan(d.master, [screener.Condition("close", ">", 10000), screener.Condition("no_such_column", ">", 1)], sort_by="close", ascending=False, limit=20, country="US"))


def _condition_sql(c: screener.Condition) -> str:
    return f"{c.column} BETWEEN {c.value} AND {c.value2}" if c.op == "between" else f"{c.column} {c.op} {c.value}"


for _name, _conditions in screener.PRESETS.items():
    # all months: at the latest one hardly a company of the test tables passes
    query(f"preset_{_name}", f"SELECT {_SHOW} FROM master WHERE {' AND '.join(map(_condition_sql, _conditions))}")(lambda d, n=_name: screener.scan(d.master, preset=n, date=None))
query("scan_indicator", f"SELECT {_SHOW} FROM latest WHERE asset_turnover >= (SELECT quantile_cont(asset_turnover, 0.1) FROM master) AND asset_turnover <= (SELECT quantile_cont(asset_turnover, 0.9) FROM master) ORDER BY asset_turnover DESC NULLS LAST, ticker LIMIT 10")(lambda d: screener.scan_indicator(d.master, "asset_turnover", percentiles=(10, 90), top=10))
query("compare", "SELECT ticker, date, close, roa, debt_ratio FROM latest WHERE ticker IN ('T1', 'T2', 'T3')")(lambda d: screener.compare(d.master, ["T1", "T2", "T3"], ["close", "roa", "debt_ratio"]))
query("sector_ranking", "SELECT sector, round(avg(debt_ratio), 4) AS value, count(debt_ratio) AS observations, round(stddev_samp(debt_ratio), 4) AS std, count(DISTINCT ticker) AS n_companies FROM latest WHERE sector IS NOT NULL GROUP BY sector HAVING count(DISTINCT ticker) >= 3")(lambda d: screener.sector_ranking(d.master, "debt_ratio", min_companies=3))


def _trend_sql(c: str) -> str:
    return f"""SELECT ticker, CASE WHEN n >= 2 THEN CASE WHEN ch > 0.05 THEN 'rising' WHEN ch < -0.05 THEN 'falling' ELSE 'stable' END END AS {c}_trend FROM (SELECT ticker, n, CASE WHEN a = 0 THEN 0 ELSE (b - a) / abs(a) END AS ch FROM (
  SELECT ticker, max(n) AS n, avg(x) FILTER (i <= n // 2) AS a, avg(x) FILTER (i > n - n // 2) AS b FROM (SELECT ticker, x, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i, count(*) OVER (PARTITION BY ticker) AS n FROM (
    SELECT ticker, date, {c} AS x, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS r FROM master) WHERE r <= 12 AND x IS NOT NULL) GROUP BY ticker))"""


query("trend", f"SELECT t.ticker, close_trend FROM (SELECT DISTINCT ticker FROM master) t LEFT JOIN ({_trend_sql('close')}) c ON t.ticker = c.ticker")(lambda d: screener.trend(d.master, "close"))
_PROF = ", ".join(f"round(l.{c}, {n}) AS {c}" for c, n in screener.PROFILE.items())
query("ticker_profile", f"SELECT l.ticker, l.sector, l.industry, l.date AS latest_date, {_PROF}, data_points, first_date, close_trend, pe_ratio_trend, roe_trend FROM latest l JOIN (SELECT ticker, count(*) AS data_points, min(date) AS first_date FROM master GROUP BY 1) g ON l.ticker = g.ticker LEFT JOIN ({_trend_sql('close')}) a ON l.ticker = a.ticker LEFT JOIN ({_trend_sql('pe_ratio')}) b ON l.ticker = b.ticker LEFT JOIN ({_trend_sql('roe')}) c ON l.ticker = c.ticker")(lambda d: screener.profiles(d.master))


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly point-in-time table."""
    return Data(spark, sf_dir).master


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
