"""Distress labels without look-ahead: rows after a delisting are cut, and a company counts as bankrupt if it showed signs of distress before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.operators.windows import dedup_by

GONE = ("DELISTED", "DEREGISTERED")
MIN_VOTES = 2


def censor(master: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of active companies, and of delisted ones up to the delisting; other states and unknown dates go."""
    known = status.select("ticker", "status", "delisting_date")
    out = master.join(known, "ticker", "left")
    return out.filter((F.col("status") == "ACTIVE") | F.col("status").isNull() | (F.col("status").isin(*GONE) & (F.col("date") <= F.col("delisting_date"))))


def distress_profile(censored: DataFrame, negative_equity: str = "always") -> DataFrame:
    """Per delisted company: shares of negative months and mean ratios.

    ever_negative_equity is 1 if equity was negative in *every* row
    ("always"); "any" asks for one such row.
    """
    share = lambda c: F.avg(F.when(F.col(c) < 0, 1.0).otherwise(0.0))
    part = lambda x: F.coalesce(F.try_divide(x, F.nullif(F.col("Assets"), F.lit(0.0))), F.lit(0.0))
    altman = 1.2 * part(F.col("AssetsCurrent") - F.col("LiabilitiesCurrent")) + 1.4 * part(F.col("RetainedEarnings")) + 3.3 * part(F.col("OperatingIncomeLoss")) + 1.0 * part(F.col("Revenues"))
    pick = {"always": F.min, "any": F.max}[negative_equity]
    return censored.filter(F.col("status").isin(*GONE)).groupBy("ticker").agg(
        pick(F.when(F.col("StockholdersEquity") < 0, 1).otherwise(0)).alias("ever_negative_equity"),
        share("StockholdersEquity").alias("pct_negative_equity"), share("NetIncomeLoss").alias("pct_negative_income"), share("OperatingCashFlow").alias("pct_negative_ocf"),
        F.avg(F.coalesce("debt_ratio", F.lit(0.0))).alias("avg_debt_ratio"), F.avg(F.coalesce("current_ratio", F.lit(999.0))).alias("avg_current_ratio"),
        F.avg(F.when((F.col("Assets") > 0) & (F.col("Liabilities") > 0), altman)).alias("avg_altman_partial"),
    )


def distress_votes(profile: DataFrame) -> DataFrame:
    signs = [F.col("ever_negative_equity") == 1, F.col("pct_negative_income") > 0.5, F.col("pct_negative_ocf") > 0.5, F.col("avg_debt_ratio") > 0.8, F.col("avg_current_ratio") < 1.0, F.col("avg_altman_partial") < 1.8]
    return profile.select("ticker", sum((F.when(s, 1).otherwise(0) for s in signs), F.lit(0)).alias("distress_signals"))


def with_target(censored: DataFrame, votes: DataFrame, min_votes: int = MIN_VOTES) -> DataFrame:
    target = F.when(F.col("status").isin(*GONE) & (F.col("distress_signals") >= min_votes), 1).otherwise(0)
    return censored.join(votes, "ticker", "left").withColumn("target_bankruptcy", target).drop("distress_signals")


def build(master: DataFrame, status: DataFrame | None) -> DataFrame:
    """The labelled table; without a status table all rows are kept with target 0."""
    if status is None:
        return master.withColumns({"status": F.lit(None).cast("string"), "delisting_date": F.lit(None).cast("date"), "target_bankruptcy": F.lit(0)})
    censored = censor(master, status)
    labelled = with_target(censored, distress_votes(distress_profile(censored)))
    newest = dedup_by(labelled, ["ticker", "date"], [F.col("end_date").desc_nulls_last(), F.col("filing_date").desc_nulls_last()])
    return newest.select(*master.columns, "status", "delisting_date", "target_bankruptcy")


def label_stats(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.countDistinct("ticker").alias("unique_tickers"), F.countDistinct("date").alias("unique_dates"), F.min("date").alias("min_date"), F.max("date").alias("max_date"), F.sum("target_bankruptcy").alias("bankrupt_rows"), F.count_if(F.col("target_bankruptcy") == 0).alias("active_rows"), F.count("*").alias("total_rows"))


def status_breakdown(labelled: DataFrame) -> DataFrame:
    return labelled.filter("status is not null").groupBy("status").agg(F.countDistinct("ticker").alias("unique_tickers"), F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def recent_delistings(labelled: DataFrame, limit: int = 10) -> DataFrame:
    g = labelled.filter(F.col("status").isin(*GONE)).groupBy("ticker", "status", "delisting_date").agg(F.max("date").alias("last_data_date"), F.count("*").alias("total_rows"))
    return g.orderBy(F.col("delisting_date").desc_nulls_last(), "ticker").limit(limit)
