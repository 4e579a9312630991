"""From landed payloads to tables: filings JSON, share counts, status, report pages, price grids, increments."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.functions.parse import cik_of, date_of, link_text, local_number, period_date, period_header  # noqa: F401
from fundalake.functions.tables import grids
from fundalake.operators.windows import dedup_by
from fundalake.plans import constants as K


FACT = "struct<start:string,end:string,val:double,form:string,filed:string,fy:int,fp:string>"
COMPANY_FACTS = f"struct<facts:map<string,map<string,struct<units:map<string,array<{FACT}>>>>>>"


def facts_of(payloads: DataFrame) -> DataFrame:
    """(key columns, taxonomy, tag, unit, pos, fact), pos being the fact's place in its list, from a column ``payload`` of company-facts JSON; null for what does not parse."""
    keys = [c for c in payloads.columns if c != "payload"]
    tags = payloads.select(*keys, F.explode(F.from_json("payload", COMPANY_FACTS)["facts"]).alias("taxonomy", "_tags")).select(*keys, "taxonomy", F.explode("_tags").alias("tag", "_t"))
    return tags.select(*keys, "taxonomy", "tag", F.explode("_t.units").alias("unit", "_facts")).select(*keys, "taxonomy", "tag", "unit", F.posexplode("_facts").alias("pos", "fact"))


def companyfacts_flatten(payloads: DataFrame) -> DataFrame:
    """Long facts of the known concepts in their allowed units."""
    names = F.create_map(*[F.lit(x) for kv in K.TAG_CONCEPT.items() for x in kv])
    rows = facts_of(payloads).filter("taxonomy = 'us-gaap'").withColumn("concept", F.try_element_at(names, F.col("tag"))).filter("concept is not null")
    allowed = F.when(F.col("concept") == K.PER_SHARE_CONCEPT, F.col("unit").isin(*K.PER_SHARE_UNITS)).otherwise(F.col("unit") == K.MONEY_UNIT)
    return rows.filter(allowed).select("ticker", "concept", "unit", date_of("fact.start").alias("start_date"), date_of("fact.end").alias("end_date"), F.col("fact.val").alias("value"), F.col("fact.form").alias("form"), date_of("fact.filed").alias("filing_date"))


def merge_facts(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("ticker", "concept", "end_date", "value")) -> DataFrame:
    """One fact per key; the old one's values, blanks of form and filing date filled from the newer ones in order."""
    both = old.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    keys, rest = list(keys), [c for c in old.columns if c not in keys]
    # rows of one source are taken by filing date
    rank = F.struct("_src", F.coalesce("filing_date", F.lit(datetime.date(9999, 12, 31))), F.coalesce("form", F.lit("")))
    late = ("form", "filing_date")
    pick = [F.min_by(c, F.when(F.col(c).isNotNull(), rank)).alias(c) if c in late else F.min_by(c, rank).alias(c) for c in rest]
    return both.groupBy(*keys).agg(*pick).select(*old.columns)


def share_history(payloads: DataFrame) -> DataFrame:
    """Share counts from the first of five tags that a company has."""
    order = {t: (i, "SEC_DEI" if t in K.SHARE_TAGS_DEI else "SEC_GAAP") for i, t in enumerate([*K.SHARE_TAGS_DEI, *K.SHARE_TAGS_GAAP])}
    prio = F.create_map(*[F.lit(x) for t, (i, _) in order.items() for x in (t, i)])
    rows = facts_of(payloads).withColumn("_p", F.try_element_at(prio, F.col("tag"))).filter("_p is not null and unit = 'shares'")
    best = rows.withColumn("_r", F.rank().over(W.partitionBy("ticker").orderBy("_p"))).filter("_r = 1")
    kind = F.when(F.col("_p") < len(K.SHARE_TAGS_DEI), "SEC_DEI").otherwise("SEC_GAAP")
    return best.select("ticker", date_of("fact.end").alias("end_date"), date_of("fact.filed").alias("filing_date"), F.col("fact.fy").alias("fiscal_year"), F.col("fact.fp").alias("fiscal_period"), F.col("fact.val").cast("long").alias("shares"), kind.alias("source_type"))


def calculated_shares(payloads: DataFrame) -> DataFrame:
    """|net income / earnings per share| of the same end, year and period, in US dollars.

    On each side the first tag that a company has, in whatever unit, is the one
    that counts.  Of several earnings of a period the last in the list does; if
    that is zero or missing, the period has no share count.
    """
    rows = facts_of(payloads).filter("taxonomy = 'us-gaap'").select("ticker", "tag", "unit", "pos", "fact.end", "fact.filed", "fact.fy", "fact.fp", "fact.val")

    def side(tags: Sequence[str], unit: str) -> DataFrame:
        prio = F.create_map(*[F.lit(x) for i, t in enumerate(tags) for x in (t, i)])
        known = rows.withColumn("_p", F.try_element_at(prio, F.col("tag"))).filter("_p is not null")
        return known.withColumn("_r", F.rank().over(W.partitionBy("ticker").orderBy("_p"))).filter((F.col("_r") == 1) & (F.col("unit") == unit)).drop("_r", "_p", "tag", "unit")

    eps = dedup_by(side(K.EPS_TAGS, K.SHARE_PRICE_UNIT), ["ticker", "end", "fy", "fp"], [F.col("pos").desc()])
    eps = eps.select(F.col("ticker").alias("t2"), F.col("end").alias("e2"), F.col("fy").alias("y2"), F.col("fp").alias("p2"), F.col("val").alias("eps")).filter("eps <> 0")
    both = side(K.INCOME_TAGS, K.MONEY_UNIT).filter("val is not null").join(eps, F.expr("ticker = t2 and end <=> e2 and fy <=> y2 and fp <=> p2"))
    shares = F.abs(F.try_divide("val", "eps")).cast("long")
    return both.select("ticker", date_of("end").alias("end_date"), date_of("filed").alias("filing_date"), F.col("fy").alias("fiscal_year"), F.col("fp").alias("fiscal_period"), shares.alias("shares"), F.lit("Calculated").alias("source_type"))


def share_counts(payloads: DataFrame) -> DataFrame:
    """The whole chain: the reported share counts of each company, or, where it reports none, the calculated ones."""
    reported = share_history(payloads)
    return reported.unionByName(calculated_shares(payloads).join(reported.select("ticker").distinct(), "ticker", "left_anti"))


def merge_new(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` and those rows of ``new`` whose key (nulls are equal) it does not have; of several with one key the first by their other columns."""
    have = old.select(*[F.col(k).alias(f"_o_{k}") for k in keys]).distinct()
    on = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    order = [F.col(c).asc_nulls_last() for c in new.columns if c not in keys] or [F.lit(1)]
    fresh = dedup_by(new.join(have, on, "left_anti"), keys, order)
    return old.unionByName(fresh)


def _grown(filings: DataFrame) -> DataFrame:
    """(cik, filings array in order) from long rows (cik, pos, form, filing_date, report_date)."""
    row = F.struct("pos", "form", "filing_date", "report_date")
    return filings.groupBy("cik").agg(F.sort_array(F.collect_list(row)).alias("_f"))


def _listed(filings: DataFrame, key: str) -> DataFrame:
    """(cik, key): parallel arrays as a filings service sends them; dates are text, missing ones empty."""
    text = lambda c: F.transform("_f", lambda r: F.coalesce(r[c].cast("string"), F.lit("")))
    number = F.transform("_f", lambda r: F.concat(F.lit("A"), F.col("cik").cast("string"), F.lit("-"), r["pos"].cast("string")))
    return _grown(filings).select("cik", F.struct(text("form").alias("form"), text("filing_date").alias("filingDate"), text("report_date").alias("reportDate"), number.alias("accessionNumber")).alias(key))


def submissions(filings: DataFrame) -> DataFrame:
    """(cik, payload) JSON of each company's recent filings."""
    return _listed(filings, "recent").select("cik", F.to_json(F.struct(F.struct("recent").alias("filings"))).alias("payload"))


def older_files(filings: DataFrame) -> DataFrame:
    """(cik, payload) JSON of the files with older filings: the arrays themselves."""
    return _listed(filings, "older").select("cik", F.to_json("older").alias("payload"))


LISTED = "struct<form:array<string>,filingDate:array<string>,reportDate:array<string>,accessionNumber:array<string>>"
SUBMISSIONS = f"struct<filings:struct<recent:{LISTED}>>"


def filings_of(payloads: DataFrame, older: bool = False) -> DataFrame:
    """(cik, pos, form, filingDate, reportDate, accessionNumber) from JSON with parallel arrays; ``older``: the JSON is that of an older file."""
    lists = F.from_json("payload", LISTED) if older else F.from_json("payload", SUBMISSIONS)["filings"]["recent"]
    names = ("form", "filingDate", "reportDate", "accessionNumber")
    # an absent array is no reason to lose the others
    zipped = F.arrays_zip(*[F.coalesce(lists[n], F.array().cast("array<string>")).alias(n) for n in names])
    return payloads.select("cik", F.posexplode(zipped).alias("pos", "_z")).select("cik", "pos", "_z.*").filter("form is not null")


def filing_status(payloads: DataFrame, as_of: datetime.date) -> DataFrame:
    """Status of each company by its filings, in list order; ERROR for a payload that does not parse, UNKNOWN without filings."""
    rows = filings_of(payloads)
    form, date = F.col("form"), F.nullif("filingDate", F.lit(""))
    first = lambda names: F.min_by(F.struct(date.alias("d"), form.alias("f")), F.when(form.isin(*names), F.col("pos")))
    own = form.isin(*K.FINANCIAL_FORMS)
    g = rows.groupBy("cik").agg(first(K.DELISTING_FORMS).alias("gone"), first(K.DEREGISTRATION_FORMS).alias("off"), F.max(F.when(own, date_of(date))).alias("latest"), F.min_by(date, "pos").alias("last_filing_date"), F.min_by(date, F.when(own, F.col("pos"))).alias("last_financial_report_date"), F.count("*").alias("n"))
    bad = (F.col("payload").isNull() | F.from_json("payload", SUBMISSIONS)["filings"]["recent"].isNull()).alias("bad")
    out = payloads.select("cik", bad).join(g, "cik", "left")
    stale = F.col("latest").isNull() | (F.datediff(F.lit(as_of), F.col("latest")) > K.ZOMBIE_DAYS)
    status = F.when(F.col("bad"), "ERROR").when(F.col("n").isNull(), "UNKNOWN").when(F.col("gone").isNotNull(), "DELISTED").when(F.col("off").isNotNull(), "DEREGISTERED").when(stale, "ZOMBIE").otherwise("ACTIVE")
    which = F.coalesce("gone", "off")
    return out.select("cik", status.alias("status"), date_of(which["d"]).alias("delisting_date"), which["f"].alias("delisting_form"), date_of("last_filing_date").alias("last_filing_date"), date_of("last_financial_report_date").alias("last_financial_report_date"))


def filing_dates(payloads: DataFrame, older: DataFrame | None = None) -> DataFrame:
    """(cik, form_type, end_date, filing_date, accession_number) of financial reports with both dates, from the recent filings and, if given, from the files with older ones."""
    rows = filings_of(payloads)
    if older is not None:
        rows = rows.unionByName(filings_of(older, older=True))
    rows = rows.filter(F.col("form").isin(*K.FINANCIAL_FORMS))
    out = rows.select("cik", F.col("form").alias("form_type"), date_of(F.nullif("reportDate", F.lit(""))).alias("end_date"), date_of(F.nullif("filingDate", F.lit(""))).alias("filing_date"), F.nullif("accessionNumber", F.lit("")).alias("accession_number"))
    return out.filter("end_date is not null and filing_date is not null")


def company_universe(companies: DataFrame) -> DataFrame:
    """``companies`` (cik, name, sic) with is_excluded: banks, insurers, funds by code or by name."""
    name = F.lower(F.coalesce("name", F.lit("")))
    fund = F.coalesce(*[F.when(name.contains(w), True) for w in K.FUND_WORDS], F.lit(False))
    return companies.withColumn("is_excluded", F.coalesce(F.col("sic").isin(*K.EXCLUDED_SIC), F.lit(False)) | fund)


def ticker_list(companies: DataFrame) -> DataFrame:
    """Different upper-case tickers of the companies that are not excluded, sorted."""
    rows = company_universe(companies).filter("not is_excluded").select(F.explode("tickers").alias("ticker")).select(F.upper(F.trim("ticker")).alias("ticker"))
    return rows.filter("ticker <> ''").distinct().orderBy("ticker")


def _listed_tickers(companies: DataFrame) -> DataFrame:
    """(cik, at, ticker) of the companies that are not excluded, in upper case, by place in their list."""
    rows = company_universe(companies).filter("not is_excluded").select("cik", F.posexplode("tickers").alias("at", "ticker"))
    return rows.withColumn("ticker", F.upper(F.trim("ticker"))).filter("ticker <> ''")


def ticker_ciks(companies: DataFrame) -> DataFrame:
    """(ticker, cik): one company for each ticker; of several the one with the greatest number."""
    return _listed_tickers(companies).groupBy("ticker").agg(F.max("cik").alias("cik"))


def primary_tickers(companies: DataFrame) -> DataFrame:
    """(cik, ticker): the first ticker in each company's list."""
    return _listed_tickers(companies).groupBy("cik").agg(F.min_by("ticker", "at").alias("ticker"))


def ohlcv_long(grid: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(date, ticker, field columns) from a row per date with columns ``<ticker>|<field>``; ``.WA`` tickers become ``.PL`` with country PL."""
    cells = grid.unpivot("date", [F.col(f"`{c}`") for c in grid.columns if c != "date"], "cell", "value")
    ticker = F.regexp_replace(F.substring_index("cell", "|", 1), r"\.WA$", ".PL")
    rows = cells.select("date", ticker.alias("ticker"), F.substring_index("cell", "|", -1).alias("field"), "value")
    out = rows.groupBy("date", "ticker").pivot("field", list(fields)).agg(F.first("value", True))
    return out.filter(F.coalesce(*[F.col(f) for f in fields]).isNotNull()).withColumn("country", F.when(F.col("ticker").endswith(".PL"), "PL").otherwise("US"))


def high_water_marks(universe: DataFrame, rows: DataFrame, date: str, overlap_days: int, default: datetime.date, country: str | None = None) -> DataFrame:
    """(ticker, start_date): the day to fetch from, for all tickers in one job; by the rows of one country, if given."""
    rows = rows.filter(F.col("country") == country) if country else rows
    last = rows.groupBy("ticker").agg(F.max(date).alias("_last"))
    return universe.select("ticker").distinct().join(last, "ticker", "left").select("ticker", F.coalesce(F.date_sub("_last", overlap_days), F.lit(default)).alias("start_date"))


def by_start(marks: DataFrame) -> DataFrame:
    return marks.groupBy("start_date").agg(F.count("*").alias("n_tickers"), F.array_join(F.sort_array(F.collect_list("ticker")), ",").alias("tickers"))


def covered_delisted(universe: DataFrame, prices: DataFrame, status: DataFrame) -> DataFrame:
    """Tickers that still need prices: all but delisted ones whose last price is on or after the delisting."""
    last = prices.groupBy("ticker").agg(F.max("date").alias("_last"))
    done = status.filter("delisting_date is not null and status in ('DELISTED', 'DEREGISTERED')").join(last, "ticker").filter("_last >= delisting_date").select("ticker")
    return universe.select("ticker").distinct().join(done, "ticker", "left_anti")


def new_facts(known: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming facts whose (ticker, end_date, value) is not known."""
    return incoming.join(known.select("ticker", "end_date", "value").distinct(), ["ticker", "end_date", "value"], "left_anti")


def merge_series(old: DataFrame, new: DataFrame) -> DataFrame:
    """(date, value) of both; the new value wins; is_new for dates that were not there."""
    both = old.select("date", "value", F.lit(0).alias("_s")).unionByName(new.select("date", "value", F.lit(1).alias("_s")))
    return both.groupBy("date").agg(F.max_by("value", "_s").alias("value"), (F.min("_s") == 1).alias("is_new"))


JSON_STAT = "struct<value:map<string,double>,dimension:struct<time:struct<category:struct<index:map<string,int>>>>>"


def jsonstat(payloads: DataFrame) -> DataFrame:
    """(keys, date, value) from JSON-stat; periods without a value are left out."""
    keys = [c for c in payloads.columns if c != "payload"]
    parsed = payloads.select(*keys, F.from_json("payload", JSON_STAT).alias("_j"))
    rows = parsed.select(*keys, "_j", F.explode(F.map_entries("_j.dimension.time.category.index")).alias("_e"))
    out = rows.select(*keys, F.col("_e.key").alias("_p"), F.try_element_at("_j.value", F.col("_e.value").cast("string")).alias("value"))
    return out.withColumn("date", period_date(F.col("_p"))).filter("date is not null and value is not null").select(*keys, "date", "value")


def report_page_facts(pages: DataFrame, labels: dict[str, str]) -> DataFrame:
    """(ticker, concept, unit, end_date, report_type, value) from the first report table of pages (ticker, html).

    The table is laid out as a grid: tables inside cells are text, cells that
    span columns or rows stand at each place, character references are decoded.
    Rows are known by their first cell, columns by their head.  A value stands in
    the cell's inner span, if it has one, or is the cell's text.
    """
    rows = pages.select(F.struct("ticker", F.xxhash64("ticker", "html").alias("page"), F.monotonically_increasing_id().alias("number")).alias("row"), "html")
    cells = rows.mapInArrow(lambda it: grids(it, "report-table"), "row struct<ticker:string,page:long,number:long>, line long, at long, cell string, inner string")
    names = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    # a page's cells come together: heads and labels are looked up within it
    page = W.partitionBy("row")
    head = F.collect_list(F.when((F.col("line") == 0) & (F.col("at") > 0), F.struct("at", period_header(F.col("cell")).alias("h")))).over(page)
    label = F.first(F.when(F.col("at") == 0, F.try_element_at(names, F.col("cell"))), ignorenulls=True).over(W.partitionBy("row", "line"))
    placed = cells.withColumns({"heads": head, "concept": label}).filter("line > 0 and at > 0 and concept is not null")
    found = placed.withColumn("h", F.get(F.filter("heads", lambda x: x["at"] == F.col("at")), F.lit(0))["h"]).filter("h is not null")
    value = local_number(F.coalesce(F.nullif("inner", F.lit("")), "cell"))
    out = found.withColumn("value", value).filter("value is not null")
    return out.select("row.ticker", "concept", F.lit("PLN").alias("unit"), F.try_to_date("h.end_date", "yyyy-MM-dd").alias("end_date"), F.col("h.report_type").alias("report_type"), "value")
