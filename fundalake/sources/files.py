"""Scans of landed files, one declared read per kind; nothing is parsed on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.operators.cleaning import classify_period, country_of, dedup_facts, fill_filing_dates
from fundalake.operators.windows import dedup_by
from fundalake.sources.schemas import conform

FILE = "_metadata.file_name"


def _csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def _date(c: str) -> Column:
    return F.coalesce(F.try_to_date(c, "yyyy-MM-dd"), F.try_to_date(F.substring(F.col(c), 1, 10), "yyyy-MM-dd"))


def newest(df: DataFrame, kind: Column) -> DataFrame:
    """Rows of the last file by name of each kind; column _file is dropped."""
    last = df.withColumn("_kind", kind)
    names = last.groupBy("_kind").agg(F.max("_file").alias("_newest"))  # a row per kind
    return last.join(F.broadcast(names), ["_kind"]).filter("_file = _newest").drop("_kind", "_newest", "_file")


def prices(spark: SparkSession, path: str) -> DataFrame:
    """The newest US and the newest PL price file (``*pl*`` by name)."""
    raw = spark.read.option("header", True).csv(path).withColumn("_file", F.col(FILE))
    raw = raw.toDF(*[c if c == "_file" else c.lower() for c in raw.columns])
    rows = newest(raw, F.when(F.lower("_file").contains("pl"), "PL").otherwise("US"))
    if "country" not in rows.columns:
        rows = rows.withColumn("country", country_of(F.col("ticker")))
    rows = rows.withColumn("date", _date("date")).withColumn("country", F.coalesce("country", country_of(F.col("ticker"))))
    return conform(rows, "prices").na.drop(subset=["ticker", "date"])


_FACT = "struct<concept:string,unit:string,start:string,end:string,value:double,form:string,filing_date:string>"


def financials(spark: SparkSession, path: str, filings: DataFrame | None = None) -> DataFrame:
    """Facts of per-ticker JSON files: an object with ``financials``, or a bare list; the ticker is the file's name."""
    text = spark.read.option("wholetext", True).text(path).select(F.regexp_extract(FILE, r"^(.*?)(?:_financials)?\.json$", 1).alias("ticker"), "value")
    found = F.coalesce(F.from_json("value", f"struct<financials:array<{_FACT}>>")["financials"], F.from_json("value", f"array<{_FACT}>"))
    rows = text.select("ticker", F.explode(found).alias("f")).select("ticker", "f.*")
    rows = rows.select("ticker", "concept", country_of(F.col("ticker")).alias("country"), "unit", _date("start").alias("start_date"), _date("end").alias("end_date"), "value", "form", _date("filing_date").alias("filing_date"))
    rows = dedup_facts(classify_period(rows.filter("end_date is not null")))
    return conform(fill_filing_dates(rows, filings) if filings is not None else rows, "financials")


def filing_dates(spark: SparkSession, path: str) -> DataFrame:
    rows = _csv(spark, path, "ticker string, cik string, form_type string, end_date string, filing_date string, accession_number string")
    return rows.select("ticker", _date("end_date").alias("end_date"), _date("filing_date").alias("filing_date")).na.drop()


def macro(spark: SparkSession, path: str, series: dict[str, str]) -> DataFrame:
    """A column per series from one CSV (date, value) each; ``series``: file name -> column.  One read and one pivot for all."""
    names = F.create_map(*[F.lit(x) for kv in series.items() for x in kv])
    rows = _csv(spark, path, "date string, value string").select(F.try_element_at(names, F.col(FILE)).alias("series"), _date("date").alias("date"), F.col("value").try_cast("double").alias("value"), F.monotonically_increasing_id().alias("_i"))
    return pivot_series(rows.filter("series is not null and date is not null"), sorted(set(series.values())))


def pivot_series(rows: DataFrame, series: list[str]) -> DataFrame:
    """(date, a column per series) from (series, date, value, _i); the last row of a date stays."""
    return rows.groupBy("date").pivot("series", series).agg(F.max_by("value", "_i"))


def dividends(spark: SparkSession, path: str, json: bool = False) -> DataFrame:
    """The newest CSV, or per-ticker JSON; one row per (ticker, date), none with a null."""
    if json:
        rows = spark.read.schema("ticker string, dividends array<struct<date:string,dividend:double>>").option("multiLine", True).json(path)
        rows = rows.select("ticker", F.explode("dividends").alias("d")).select("ticker", _date("d.date").alias("dividend_date"), F.col("d.dividend").alias("dividend_amount"))
    else:
        raw = newest(_csv(spark, path, "Ticker string, Date string, Dividend string").withColumn("_file", F.col(FILE)), F.lit(1))
        rows = raw.select(F.col("Ticker").alias("ticker"), _date("Date").alias("dividend_date"), F.col("Dividend").try_cast("double").alias("dividend_amount"))
    rows = rows.withColumn("country", country_of(F.col("ticker"))).na.drop()
    return conform(dedup_by(rows, ["ticker", "dividend_date", "country"], [F.col("dividend_amount").desc()]), "dividends")


def sectors(spark: SparkSession, path: str) -> DataFrame:
    """All files; the last file by name wins per (ticker, country)."""
    rows = _csv(spark, path, "Ticker string, Sector string, Industry string").withColumn("_file", F.col(FILE)).withColumn("country", country_of(F.col("Ticker")))
    g = rows.groupBy(F.col("Ticker").alias("ticker"), "country").agg(F.max_by(F.struct("Sector", "Industry"), "_file").alias("m"))
    return conform(g.select("ticker", "country", F.col("m.Sector").alias("sector"), F.col("m.Industry").alias("industry")).filter("ticker is not null"), "sectors")


def shares(spark: SparkSession, path: str) -> DataFrame:
    kind = "ticker string, shares_history array<struct<end:string,filed:string,fy:string,fp:string,value:double,source_type:string>>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path).select("ticker", F.posexplode("shares_history").alias("_i", "s"))
    rows = rows.select("ticker", _date("s.filed").alias("filing_date"), country_of(F.col("ticker")).alias("country"), F.col("s.value").cast("long").alias("shares"), _date("s.end").alias("end_date"), F.col("s.fy").try_cast("int").alias("fiscal_year"), F.col("s.fp").alias("fiscal_period"), F.col("s.source_type").alias("source_type"), "_i")
    return conform(dedup_by(rows.filter("filing_date is not null"), ["ticker", "filing_date", "country"], [F.col("_i").desc()]), "shares_outstanding")


def company_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A row per company and ticker, with its first exchange."""
    kind = "companies array<struct<cik:string,name:string,sic:string,sic_description:string,tickers:array<string>,exchanges:array<string>,all_tickers:array<string>>>"
    rows = spark.read.schema(kind).option("multiLine", True).json(path).select(F.explode("companies").alias("c")).select("c.*")
    rows = rows.select("cik", F.explode("all_tickers").alias("ticker"), F.col("name").alias("company_name"), F.nullif("sic", F.lit("")).try_cast("int").alias("sic"), "sic_description", F.try_element_at("exchanges", F.lit(1)).alias("exchange"), F.lit(False).alias("is_excluded"))
    return conform(rows, "company_metadata")


def company_status(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("header", True).csv(path)
    rows = rows.withColumns({c: _date(c) for c in rows.columns if c.endswith("_date")}).filter("ticker is not null")
    out = conform(rows.withColumn("country", country_of(F.col("ticker"))), "company_status")
    return dedup_by(out, ["ticker", "country"], [F.col("last_filing_date").desc_nulls_last(), F.col("status")])
