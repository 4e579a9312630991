"""Features of the labelled table, and their preparation for models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundalake.operators.ranks import long, quantiles, running
from fundalake.sources.staging import materialized

KEY_FEATURES = (
    "current_ratio quick_ratio roe roa ros operating_margin gross_margin debt_ratio debt_to_equity ocf_ratio free_cash_flow fcf_ttm asset_turnover "
    "revenue_growth net_income_growth price_to_book Assets Liabilities StockholdersEquity Revenues NetIncomeLoss OperatingCashFlow"
).split()
EXCLUDED = "ticker date end_date filing_date fiscal_quarter country sector industry status delisting_date target_bankruptcy".split()
TREND = ("roe", "roa", "debt_ratio", "current_ratio", "revenue_growth")
LAGGED = ("roe", "debt_ratio", "current_ratio", "close")


def altman(df: DataFrame) -> DataFrame:
    """X1 to X5 and Z; a zero denominator gives null."""
    over = lambda a, b: F.try_divide(a, F.nullif(F.col(b).cast("double"), F.lit(0.0)))
    df = df.withColumns({
        "altman_x1": over(F.col("AssetsCurrent") - F.col("LiabilitiesCurrent"), "Assets"),
        "altman_x2": over(F.col("RetainedEarnings"), "Assets"),
        "altman_x3": over(F.col("OperatingIncomeLoss"), "Assets"),
        "altman_x4": over(F.col("close") * F.col("shares_outstanding"), "Liabilities"),
        "altman_x5": over(F.col("Revenues"), "Assets"),
    })
    return df.withColumn("altman_z_approx", 1.2 * F.col("altman_x1") + 1.4 * F.col("altman_x2") + 3.3 * F.col("altman_x3") + 0.6 * F.col("altman_x4") + 1.0 * F.col("altman_x5"))


def distress_flags(df: DataFrame) -> DataFrame:
    """Six flags, 0 for null, and their sum."""
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    flags = {
        "negative_equity": flag(F.col("StockholdersEquity") < 0), "negative_income": flag(F.col("NetIncomeLoss") < 0), "negative_ocf": flag(F.col("OperatingCashFlow") < 0),
        "revenue_decline": flag(F.col("revenue_growth") < 0), "high_leverage": flag(F.col("debt_to_equity") > 2.0), "low_liquidity": flag(F.col("current_ratio") < 1.0),
    }
    return df.withColumns(flags).withColumn("distress_score", reduce(lambda a, b: a + b, [F.col(c) for c in flags]))


def trends(df: DataFrame, windows: tuple[int, ...] = (3, 6, 12)) -> DataFrame:
    """Means and standard deviations over the last rows of the ticker; all in one window sort."""
    out = {}
    for n in windows:
        w = W.partitionBy("ticker").orderBy("date").rowsBetween(1 - n, 0)
        for c in TREND:
            out[f"{c}_ma{n}"] = F.avg(c).over(w)
            out[f"{c}_std{n}"] = F.stddev_samp(c).over(w)
    return df.withColumns(out)


def lags(df: DataFrame, steps: tuple[int, ...] = (1, 3, 6)) -> DataFrame:
    w = W.partitionBy("ticker").orderBy("date")
    return df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(w) for c in LAGGED for n in steps})


def pipeline(df: DataFrame, with_altman: bool = True, with_distress: bool = True, with_trends: bool = True, with_lags: bool = True) -> DataFrame:
    for wanted, step in ((with_altman, altman), (with_distress, distress_flags), (with_trends, trends), (with_lags, lags)):
        df = df.transform(step) if wanted else df
    return df


def numeric(df: DataFrame) -> list[str]:
    """Numeric columns that are not keys, labels or leaks."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in EXCLUDED]


def _finite(c: str):
    x = F.col(c).cast("double")
    return F.when(F.isnan(x) | x.isin(float("inf"), float("-inf")), None).otherwise(x)


class Prepared:
    """What is learned on the training side: columns that stay, and their fill values."""

    def __init__(self, columns: list[str], fill: dict[str, float]) -> None:
        self.columns, self.fill = columns, fill

    def apply(self, df: DataFrame) -> DataFrame:
        """Target and features; a feature that ``df`` lacks is 0."""
        values = [F.coalesce(_finite(c), F.lit(self.fill[c])).alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in self.columns]
        keys = [c for c in ("ticker", "date") if c in df.columns]
        return df.filter("target_bankruptcy is not null").select(*keys, "target_bankruptcy", *values)


def prepare(df: DataFrame, strategy: str = "median", max_missing: float = 0.9) -> Prepared:
    """Columns with less than ``max_missing`` blanks and some variance; a pass for rates, one for medians, one for variances.

    Strategies: median, zero, carry (see carried).
    """
    rows = df.filter("target_bankruptcy is not null")
    names = numeric(rows)
    clean = rows.select(*[_finite(c).alias(c) for c in names])
    got = clean.agg(F.count("*").alias("n"), *[F.count(c).alias(f"{c}__n") for c in names]).first()
    if not got["n"]:
        return Prepared([], {})
    stay = [c for c in names if 1 - got[f"{c}__n"] / got["n"] < max_missing]
    middle = {r.column: r._p[0] for r in quantiles(long(clean, stay), ["column"], "value", [0.5]).collect()} if strategy == "median" and stay else {}  # a row per column
    fill = {c: middle.get(c, 0.0) for c in stay}
    spread = clean.agg(*[F.variance(F.coalesce(c, F.lit(fill[c]))).alias(c) for c in stay]).first() if stay else {}
    kept = [c for c in stay if spread[c]]
    return Prepared(kept, {c: fill[c] for c in kept})


def carried(df: DataFrame) -> DataFrame:
    """Blanks filled from the row before of the same ticker, else from the next one (what is left is filled with 0 by Prepared)."""
    back = W.partitionBy("ticker").orderBy("date").rowsBetween(W.unboundedPreceding, 0)
    ahead = W.partitionBy("ticker").orderBy("date").rowsBetween(0, W.unboundedFollowing)
    return df.withColumns({c: F.coalesce(F.last(_finite(c), True).over(back), F.first(_finite(c), True).over(ahead)) for c in numeric(df)})


def time_split(df: DataFrame, test: float = 0.2) -> DataFrame:
    """A column split: test from the (1 - test) quantile of the different dates on.  The dates are some hundred rows."""
    dates = df.select("date").distinct()
    numbered = dates.withColumn("_i", F.row_number().over(W.orderBy("date")) - 1).withColumn("_n", F.count("*").over(W.partitionBy()))
    cut = numbered.filter(F.col("_i") == F.floor(F.col("_n") * (1 - test))).select(F.col("date").alias("_cut"))
    return df.join(F.broadcast(cut), how="left").withColumn("split", F.when(F.col("date") >= F.col("_cut"), "test").otherwise("train")).drop("_cut")


def walk_forward(df: DataFrame, folds: int = 5, embargo_months: int = 12) -> DataFrame:
    """(``df``, fold, side): expanding windows over the different dates.

    The dates are cut into ``folds`` + 1 parts of equal number; fold i tests on
    part i + 1 and trains on all rows of at least ``embargo_months`` before its
    first date, the time that a label looks ahead.  A row comes once for each
    fold that uses it.  The parts are found in a row a date.
    """
    dates = df.select("date").na.drop().distinct()
    numbered = dates.select("date", (F.row_number().over(W.orderBy("date")) - 1).alias("_i"), F.count("*").over(W.partitionBy()).alias("_n"))
    part = numbered.select("date", F.floor(F.col("_i") * (folds + 1) / F.col("_n")).alias("fold"))
    spans = part.filter("fold > 0").groupBy("fold").agg(F.min("date").alias("_from"), F.max("date").alias("_to"))  # a row a fold
    trains = F.col("date") <= F.add_months("_from", -embargo_months)
    tests = F.col("date").between(F.col("_from"), F.col("_to"))
    out = df.join(F.broadcast(spans), trains | tests)
    return out.withColumn("side", F.when(tests, "test").otherwise("train")).drop("_from", "_to")


def random_split(df: DataFrame, test: float = 0.2, seed: int = 42) -> DataFrame:
    """A column split: test for that share of the rows, by a hash of their key and the seed; reruns and other partitionings agree."""
    place = F.md5(F.concat_ws("|", F.lit(str(seed)), "ticker", F.col("date").cast("string")))
    return df.withColumn("split", F.when(place < f"{int(test * 2**32):08x}", "test").otherwise("train"))


def aligned_split(df: DataFrame, test: float = 0.2, strategy: str = "median", legacy: bool = False) -> DataFrame:
    """Both sides prepared by the training side (legacy: the test side filled with its own medians), with the split column."""
    split = time_split(df, test)
    train, held = (split.filter(F.col("split") == x).drop("split") for x in ("train", "test"))
    if strategy == "carry":
        train, held = carried(train), carried(held)
    fitted = prepare(train, "zero" if strategy == "carry" else strategy)
    own = prepare(held, strategy) if legacy else fitted
    other = Prepared(fitted.columns, {c: own.fill.get(c, 0.0) for c in fitted.columns})
    return fitted.apply(train).withColumn("split", F.lit("train")).unionByName(other.apply(held).withColumn("split", F.lit("test")))


def select_f(df: DataFrame, columns: list[str], target: str = "target_bankruptcy") -> DataFrame:
    """(feature, score): the ANOVA F of each column between the classes; rows with any null are left out.  One aggregation."""
    full = df.na.drop(subset=[*columns, target])
    cells = long(full, columns, F.col(target).alias("y")).withColumnsRenamed({"column": "feature", "value": "x"})
    by_class = cells.groupBy("feature", "y").agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    w = W.partitionBy("feature")
    total = by_class.withColumn("grand", F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w))
    g = total.groupBy("feature").agg(F.sum(F.col("n") * (F.col("m") - F.col("grand")) ** 2).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"), F.count("*").alias("k"), F.sum("n").alias("n"))
    return g.select("feature", F.try_divide(F.try_divide(F.col("between"), F.col("k") - 1), F.try_divide(F.col("within"), F.col("n") - F.col("k"))).alias("score"))


def select_chi2(df: DataFrame, columns: list[str], target: str = "target_bankruptcy") -> DataFrame:
    """(feature, score): chi-squared of the class sums of each column, shifted to begin at 0."""
    full = df.na.drop(subset=[*columns, target])
    cells = long(full, columns, F.col(target).alias("y")).withColumnsRenamed({"column": "feature", "value": "x"})
    by_class = cells.groupBy("feature", "y").agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.min("x").alias("lo"))
    w = W.partitionBy("feature")
    seen = by_class.withColumn("low", F.min("lo").over(w)).withColumn("observed", F.col("s") - F.col("n") * F.col("low"))
    want = seen.withColumn("expected", F.sum("observed").over(w) * F.col("n") / F.sum("n").over(w))
    return want.groupBy("feature").agg(F.sum(F.try_divide((F.col("observed") - F.col("expected")) ** 2, F.nullif("expected", F.lit(0.0)))).alias("score"))


#: Different values of a class in a slot of the neighbour search.
SLOT_VALUES = 4096


def _digamma(x: Column) -> Column:
    """Of a positive number: ten steps up, then the asymptotic series."""
    far = x + 10
    steps = reduce(lambda a, b: a + b, [1 / (x + i) for i in range(10)])
    inverse = 1 / (far * far)
    series = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse * (1 / 240 - inverse * (1 / 132)))))
    return F.log(far) - 1 / (2 * far) - series - steps


def _nearest(counts: DataFrame, k: int, slot: int) -> DataFrame:
    """``counts`` (feature, y, x, n: the different values of each class) with _lo, _hi and _r: no row of the class but the k - 1 nearest lies strictly between _lo and _hi, which are _r from x.

    The values of a class are ranked in two levels and dealt into slots of
    ``slot`` ranks; each slot also gets the k values before and after it.
    """
    ranked = running(counts.withColumn("one", F.lit(1)), ["feature", "y"], "x", "one").drop("_total", "one")
    places = F.array_distinct(F.array(*[F.floor((F.col("_below") + d) / slot) for d in (-k, 0, k)]))
    dealt = ranked.withColumn("_at", F.explode(places))
    near = W.partitionBy("feature", "y", "_at").orderBy("x").rowsBetween(-k, k)
    rows = dealt.withColumn("_near", F.collect_list(F.struct("x", "n")).over(near)).filter(F.col("_at") == F.floor(F.col("_below") / slot))
    key = ["feature", "y", "x"]
    each = rows.select(*key, "n", "_k", "_ny", F.explode("_near").alias("v"))
    each = each.select(*key, "n", "_k", "_ny", F.abs(F.col("v.x") - F.col("x")).alias("d"), F.col("v.x").alias("v"), (F.col("v.n") - (F.col("v.x") == F.col("x")).cast("int")).alias("m"))
    # the first distance within which there are _k rows besides the row itself; equal distances count together
    value = W.partitionBy(*key)
    seen = F.sum("m").over(value.orderBy("d").rangeBetween(W.unboundedPreceding, W.currentRow))
    each = each.withColumn("_seen", seen).withColumn("_r", F.min(F.when(F.col("_seen") >= F.col("_k"), F.col("d"))).over(value))
    # the bound on the side where that neighbour is, is the neighbour itself: a sum could miss it by a rounding
    at = F.col("d") == F.col("_r")
    ends = [F.max(F.when(at & (F.col("v") < F.col("x")), F.col("v"))).alias("_lo"), F.min(F.when(at & (F.col("v") > F.col("x")), F.col("v"))).alias("_hi")]
    g = each.groupBy(*key).agg(*[F.first(c).alias(c) for c in ("n", "_k", "_ny", "_r")], *ends)
    return g.withColumns({"_lo": F.coalesce("_lo", F.col("x") - F.col("_r")), "_hi": F.coalesce("_hi", F.col("x") + F.col("_r"))})


def select_mi(df: DataFrame, columns: list[str], target: str = "target_bankruptcy", neighbours: int = 3, slot: int = SLOT_VALUES) -> DataFrame:
    """(feature, score): mutual information in nats of each column with the class, estimated by nearest neighbours.

    For each row: r is the distance to its k-th neighbour of the same class
    (fewer, if the class is smaller), m the number of all rows nearer than r,
    itself included (at distance 0, if r is 0; equal values are not moved apart by noise).
    The score is digamma(n) + mean digamma(k) - mean digamma(class size) - mean digamma(m),
    0 at least.  Rows with any null are left out, and so is the row of a class
    that has no other.  Everything is done on the different values: neighbours
    in slots of ranks, m from the running counts at both ends of the neighbourhood.
    """
    full = df.na.drop(subset=[*columns, target])
    cells = long(full, columns, F.col(target).alias("y")).withColumnsRenamed({"column": "feature", "value": "x"}).filter(~F.isnan("x"))
    counts = cells.groupBy("feature", "y", (F.col("x") + F.lit(0.0)).alias("x")).agg(F.count("*").alias("n"))
    sizes = counts.groupBy("feature", "y").agg(F.sum("n").alias("_ny")).withColumn("_k", F.least(F.lit(neighbours), F.col("_ny") - 1))
    counts = materialized(counts.join(sizes, ["feature", "y"]).filter("_ny > 1"), "mi-counts")
    rows = materialized(_nearest(counts, neighbours, slot), "mi-nearest")
    # counts below each value, and below each bound, which has a count of its own only where it is a value
    values = counts.groupBy("feature", "x").agg(F.sum("n").alias("n"))
    bounds = rows.select("feature", F.explode(F.array("_lo", "_hi")).alias("x")).withColumn("n", F.lit(0).cast("long"))
    below = materialized(running(values.unionByName(bounds).groupBy("feature", "x").agg(F.sum("n").alias("n")), ["feature"], "x"), "mi-below")
    at = lambda name: below.select("feature", F.col("x").alias(name), F.col("_below").alias(f"{name}_below"), (F.col("_below") + F.col("n")).alias(f"{name}_upto"))
    rows = rows.join(at("x"), ["feature", "x"]).join(at("_lo"), ["feature", "_lo"]).join(at("_hi"), ["feature", "_hi"])
    m = F.when(F.col("_r") == 0, F.col("x_upto") - F.col("x_below")).otherwise(F.col("_hi_below") - F.col("_lo_upto"))
    mean = lambda x: F.sum(F.col("n") * _digamma(x)) / F.sum("n")
    score = _digamma(F.sum("n")) + mean(F.col("_k")) - mean(F.col("_ny")) - mean(m)
    return rows.groupBy("feature").agg(F.greatest(score, F.lit(0.0)).alias("score"))


def top_features(scores: DataFrame, n: int = 20) -> DataFrame:
    return scores.orderBy(F.col("score").desc_nulls_last(), "feature").limit(n)
