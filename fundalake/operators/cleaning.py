"""From landed tables to clean ones: facts, prices, dividends, shares, macro series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundalake.operators.asof import asof_join
from fundalake.operators.windows import dedup_by, filled_forward
from fundalake.plans.constants import CONCEPTS

DAYS_A_MONTH = 30.44


def months_between(start: str, end: str, half_even: bool = False) -> Column:
    x = F.datediff(F.col(end), F.col(start)) / F.lit(DAYS_A_MONTH)
    return (F.bround(x) if half_even else F.round(x)).cast("int")


def country_of(ticker: Column) -> Column:
    return F.when(ticker.endswith(".PL"), "PL").otherwise("US")


def classify_period(facts: DataFrame) -> DataFrame:
    """value_source: snapshot without a start, discrete for 2 to 4 months, otherwise cumulative."""
    months = months_between("start_date", "end_date", half_even=True)
    return facts.withColumn("value_source", F.when(F.col("start_date").isNull(), "snapshot").when(months.between(2, 4), "discrete").otherwise("cumulative"))


def dedup_facts(facts: DataFrame) -> DataFrame:
    """One fact per (ticker, concept, end_date): not cumulative before cumulative, then the newest filing, then the largest value.

    The key's hash comes first and the first two in one number, so that the sort
    seldom compares strings; an unknown source comes before both.
    """
    key = ["ticker", "concept", "end_date"]
    source = F.when(F.col("value_source") == "cumulative", 0).when(F.col("value_source").isNotNull(), 1).otherwise(2)
    ranked = facts.withColumns({"_hash": F.xxhash64(*key), "_rank": source * F.lit(1 << 40) + F.coalesce(F.unix_date("filing_date").cast("long"), F.lit(-(1 << 39)))})
    last = [F.col("fact_id").asc()] if "fact_id" in facts.columns else []
    return dedup_by(ranked, ["_hash", *key], [F.col("_rank").desc(), F.col("value").desc_nulls_last(), *last]).drop("_hash", "_rank")


def first_filings(filings: DataFrame) -> DataFrame:
    """Earliest filing per (ticker, end_date)."""
    return filings.filter("filing_date is not null").groupBy("ticker", "end_date").agg(F.min("filing_date").alias("first_filing_date"))


def fill_filing_dates(facts: DataFrame, filings: DataFrame) -> DataFrame:
    known = first_filings(filings)
    return facts.join(known, ["ticker", "end_date"], "left").withColumn("filing_date", F.coalesce("filing_date", "first_filing_date")).drop("first_filing_date")


def nearest_filing(facts: DataFrame) -> DataFrame:
    """Earliest filing after the end date per (ticker, end_date), with its form (ties: the first form by name)."""
    late = facts.filter("end_date is not null and filing_date is not null and filing_date > end_date")
    first = late.groupBy("ticker", "end_date").agg(F.min(F.struct("filing_date", F.coalesce("form", F.lit("￿")).alias("form"))).alias("m"))
    return first.select("ticker", "end_date", F.col("m.filing_date").alias("nearest_filing_date"), F.nullif(F.col("m.form"), F.lit("￿")).alias("nearest_form"))


def fill_facts(facts: DataFrame) -> DataFrame:
    """Facts with a value and an end date; form and filing date filled from the group, then by default."""
    source = F.when(F.col("start_date").isNull(), "snapshot").otherwise("cumulative")
    out = facts.join(nearest_filing(facts), ["ticker", "end_date"], "left").filter("value is not null and end_date is not null")
    return out.withColumns({
        "value_source": F.coalesce("value_source", source),
        "form": F.coalesce("form", "nearest_form", F.lit("forecasted")),
        "filing_date": F.coalesce("filing_date", "nearest_filing_date", F.add_months("end_date", 1)),
    }).drop("nearest_filing_date", "nearest_form")


def quarterly(facts: DataFrame, strict: bool = False) -> DataFrame:
    """Discrete quarters from year-to-date values, with the period's kind, length, quarter and completeness.

    The difference is to the row before in the year of the start date, whatever
    its source; ``strict`` looks at cumulative rows only.
    """
    facts = facts.repartition("ticker", "concept")  # one shuffle for the windows by year of start and by year of end
    by_year = W.partitionBy("ticker", "concept", F.year("start_date"))
    ordered = by_year.orderBy("end_date")
    if strict:
        kept = F.when(F.col("value_source") == "cumulative", F.col("value"))
        before = F.last(kept, ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    else:
        before = F.lag("value").over(ordered)
    snapshot = F.col("start_date").isNull()
    direct = (F.col("value_source") == "discrete") | F.col("_before").isNull()
    m, month_q = F.col("_months"), F.quarter("end_date").cast("string")
    quarter = (
        F.when(snapshot | m.isin(2, 3, 4), month_q)
        .when(m.isin(5, 6, 7), "2")
        .when(m.isin(8, 9, 10), "3")
        .when(m >= 11, F.when(F.col("_reports") == 1, "FY").otherwise("4"))
        .otherwise("OTHER")
    )
    out = facts.withColumns({"_before": before, "_months": months_between("start_date", "end_date"), "_reports": F.count("*").over(by_year)})
    out = out.withColumns({
        "value_quarterly": F.when(snapshot | direct, F.col("value")).otherwise(F.col("value") - F.col("_before")),
        "value_quarterly_source": F.when(snapshot, "snapshot").when(direct, "direct").otherwise("calculated"),
        "period_type": F.when(snapshot, "SNAPSHOT").otherwise("FLOW"),
        "period_length_months": F.when(~snapshot, m),
        "fiscal_quarter": quarter,
    })
    # distinct window aggregates do not exist: the size of the collected set, at most a few labels
    have = F.size(F.collect_set("fiscal_quarter").over(W.partitionBy("ticker", "concept", F.year("end_date"))))
    out = out.withColumn("quarters_available", have.cast("long")).withColumn("year_complete", F.col("quarters_available") >= 4)
    return out.select("ticker", "concept", "country", "unit", "end_date", "fiscal_quarter", "filing_date", "form", "value_quarterly", "value_quarterly_source", "period_type", "period_length_months", "quarters_available", "year_complete")


def period_distribution(clean: DataFrame) -> DataFrame:
    return clean.groupBy("period_type", "fiscal_quarter").agg(F.count("*").alias("n"))


def mixed_quarters(clean: DataFrame, limit: int = 10) -> DataFrame:
    """(ticker, end_date) with more than one quarter; the first ones by key."""
    g = clean.filter("fiscal_quarter is not null").groupBy("ticker", "end_date").agg(F.countDistinct("fiscal_quarter").alias("distinct_quarters"), F.array_join(F.sort_array(F.collect_set("fiscal_quarter")), ", ").alias("quarters"))
    return g.filter("distinct_quarters > 1").orderBy("ticker", "end_date").limit(limit)


def flow_quarter(clean: DataFrame) -> DataFrame:
    return clean.filter("period_type = 'FLOW'").groupBy("ticker", "country", "end_date").agg(F.min("fiscal_quarter").alias("fiscal_quarter"))


def snapshot_to_flow(clean: DataFrame, max_days: int = 365) -> DataFrame:
    """Each snapshot date with the next flow date of its ticker, at most ``max_days`` later."""
    dates = clean.filter("period_type = 'SNAPSHOT'").select("ticker", "country", F.col("end_date").alias("snapshot_date")).distinct()
    flows = flow_quarter(clean).select("ticker", "country", F.col("end_date").alias("flow_date"))
    out = asof_join(dates, flows, ["ticker", "country"], "snapshot_date", "flow_date", "forward", plan="window")
    out = out.select("ticker", "country", "snapshot_date", F.col("_match.flow_date").alias("flow_date"))
    return out.filter(F.datediff("flow_date", "snapshot_date") <= max_days)


def redate(clean: DataFrame, max_days: int = 365) -> DataFrame:
    """Flows at their date, snapshots at the flow date they belong to, all with that date's quarter; other snapshots go.

    The next flow date comes from a row per date, so ``clean`` is read twice and
    its facts meet the dates in one join.
    """
    flow = F.col("period_type") == "FLOW"
    dates = clean.groupBy("ticker", "country", "end_date").agg(F.max(flow).alias("_has"), F.min(F.when(flow, F.col("fiscal_quarter"))).alias("_quarter"))
    ahead = W.partitionBy("ticker", "country").orderBy("end_date").rowsBetween(0, W.unboundedFollowing)
    following = F.first(F.when(F.col("_has"), F.struct(F.col("end_date").alias("date"), F.col("_quarter").alias("quarter"))), ignorenulls=True).over(ahead)
    to = dates.select("ticker", "country", "end_date", following.alias("_to"))
    near = F.datediff("_to.date", "end_date") <= max_days  # 0 for flows
    moved = clean.drop("fiscal_quarter").join(to, ["ticker", "country", "end_date"]).filter(near)
    return moved.withColumns({"end_date": F.col("_to.date"), "fiscal_quarter": F.col("_to.quarter")}).drop("_to")


def wide(redated: DataFrame) -> DataFrame:
    """A row per (ticker, end_date, fiscal_quarter, country) and a column per concept; one aggregation."""
    items = [F.max(F.when(F.col("concept") == c, F.col("value_quarterly"))).alias(c) for c in CONCEPTS]
    return redated.groupBy("ticker", "end_date", "fiscal_quarter", "country").agg(F.max("filing_date").alias("filing_date"), *items)


def clean_prices(prices: DataFrame) -> DataFrame:
    return prices.filter("close is not null and close > 0")


def clean_dividends(dividends: DataFrame) -> DataFrame:
    return dividends.filter("dividend_amount is not null and dividend_amount > 0")


def clean_sectors(sectors: DataFrame) -> DataFrame:
    return sectors.filter("sector is not null")


def clean_shares(shares: DataFrame) -> DataFrame:
    """Positive counts; the end of the quarter from fiscal year and period; gaps filled forward."""
    end = F.col("fiscal_period")
    month_end = F.when(end == "Q1", F.make_date("fiscal_year", F.lit(3), F.lit(31))).when(end == "Q2", F.make_date("fiscal_year", F.lit(6), F.lit(30))).when(end == "Q3", F.make_date("fiscal_year", F.lit(9), F.lit(30)))
    month_end = month_end.when(end.isin("Q4", "FY"), F.make_date("fiscal_year", F.lit(12), F.lit(31))).otherwise(F.col("end_date"))
    out = shares.filter("shares is not null and shares > 0").withColumn("end_date", month_end)
    return out.withColumn("shares", filled_forward("shares", ["ticker", "country"], [F.col("filing_date").asc_nulls_last()]))


def yoy(column: str, w) -> Column:
    return (F.try_divide(F.col(column), F.lag(column, 12).over(w)) - 1) * 100


def macro_changes(macro: DataFrame) -> DataFrame:
    """Year-on-year change over 12 rows and change to the row before, of each series.  One task: some hundred months."""
    w = W.orderBy("date")
    series = [c for c in macro.columns if c != "date"]
    return macro.select("date", *[yoy(c, w).alias(f"{c}_yoy") for c in series], *[(F.col(c) - F.lag(c).over(w)).alias(f"{c}_diff") for c in series])


def normalize_macro(macro: DataFrame) -> DataFrame:
    """A row per month and country; what is published on the first of the next month."""
    w = W.orderBy("date")

    def country(code: str, suffix: str, retail: str, cpi: Column) -> DataFrame:
        unemployment, rate = f"unemployment_rate_{suffix}", f"interest_rate_{suffix}"
        change = lambda c: F.col(c) - F.lag(c).over(w)
        return macro.select(
            F.col("date").alias("period_date"), F.lit(code).alias("country"), F.add_months(F.trunc("date", "MM"), 1).alias("publication_date"),
            yoy(retail, w).alias("retail_sales_yoy"), yoy(f"gdp_real_{suffix}", w).alias("gdp_yoy"), cpi.alias("cpi_yoy"),
            F.col(unemployment).alias("unemp_level"), change(unemployment).alias("unemp_diff"), F.col(rate).alias("rate_level"), change(rate).alias("rate_diff"),
        )

    us = country("US", "usa", "retail_sales_usa", yoy("inflation_usa", w))
    pl = country("PL", "pl", "retail_sales_index_pl", F.col("inflation_pl"))
    out = us.unionByName(pl)
    return out.na.drop("all", subset=out.columns[3:])
