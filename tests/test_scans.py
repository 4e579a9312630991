"""The base tables are read once for all that the point-in-time table takes from them."""

import datetime
import random
import shutil

from oracle_check import SF
from pyspark.sql import functions as F

from fundalake.operators import cleaning
from fundalake.operators.windows import dedup_by
from fundalake.plans.registry import Data, queries
from fundalake.sources import proxies


def _lines(spark):
    """Some days with two tickers' lines: unpaid, null and late ones among them."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        day = datetime.datetime(1996, 1, 1, 13) + datetime.timedelta(days=rng.randrange(400))
        price = rng.choice([None, float(rng.randrange(1000)), float("nan")]) if i % 7 == 0 else rng.randrange(10**6) / 100
        rows.append((rng.randrange(1, 200), rng.randrange(10**7), rng.choice([None, 5, 45, 11, 51, 91, 7]), rng.randrange(1, 6), float(rng.randrange(50)), price, rng.choice([None, 0.0, 0.05, 0.1]), rng.choice(["R", "A", None]), None if i % 50 == 0 else day))
    return spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp")


def test_tables_by_day_are_those_of_the_lines(spark, tmp_path):
    made = str(tmp_path)
    _lines(spark).coalesce(1).write.parquet(f"{made}/lineitem.parquet")
    for sf_dir in (SF, made):
        days = proxies.days(spark, sf_dir)
        assert days.groupBy("tk", "day").count().filter("count > 1").count() == 0
        for name in proxies.BY_DAY:
            plain, ours = proxies.view(spark, sf_dir, name), proxies.by_day(name, days)
            assert [(f.name, f.dataType) for f in plain.schema] == [(f.name, f.dataType) for f in ours.schema]
            text = lambda df: sorted(str(tuple(r)) for r in df.collect())
            assert text(plain) == text(ours) and plain.count() > 0


def test_the_point_in_time_table_plans_no_scan_of_lines_or_orders(spark):
    """What it takes from them is made before, once; a scan for each branch was in its plan."""
    names = [f for leaf in Data(spark, SF).known.inputFiles() for f in ("lineitem.parquet", "orders.parquet") if f in leaf]
    assert not names


def _calls(spark, tmp_path, monkeypatch, names):
    """How often each base table is planned to be read for these queries together, over a folder that nothing is staged of."""
    at = shutil.copytree(SF, tmp_path / "sf")
    calls = {}

    def counted(f, tables):
        def call(*a):
            for t in tables(*a):
                calls[t] = calls.get(t, 0) + 1
            return f(*a)

        return call

    monkeypatch.setattr(proxies, "view", counted(proxies.view, lambda s, d, name: [name]))
    monkeypatch.setattr(proxies, "days", counted(proxies.days, lambda s, d: ["days"]))
    for name in names:
        queries()[name](spark, str(at)).count()
    return calls


#: Queries that share the staged tables.
SHARING = ["distress_votes", "validate_forward", "walk_forward", "boosted", "importance", "corr_pearson", "aligned_split"]


def test_queries_share_one_reading(spark, tmp_path, monkeypatch):
    """Lines are summed once for all of them, facts and months taken once; the rest is small."""
    calls = _calls(spark, tmp_path, monkeypatch, SHARING)
    assert {t: calls.get(t) for t in ("days", "financials", "macro")} == {"days": 1, "financials": 1, "macro": 1}
    assert not {"prices", "dividends", "shares"} & set(calls)


def _odd_orders(spark, path):
    """Orders of few keys, so that sources, filing dates and values meet: null, negative and late ones among them, hours of the day, NaN."""
    rng = random.Random(8)
    rows = []
    for i in range(-500, 6000):
        day = datetime.datetime(1996, 1, 1) + datetime.timedelta(days=rng.randrange(500), hours=rng.choice([0, 0, 13, 23]))
        price = rng.choice([None, float("nan"), 0.0, -0.0]) if i % 11 == 0 else float(rng.randrange(6))
        rows.append((None if i % 101 == 0 else i, rng.choice([None, -3, 1, 41, 5, 45]), rng.choice(["F", "O", "P", None]), price, None if i % 53 == 0 else day, rng.choice(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", None])))
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").coalesce(2).write.parquet(f"{path}/orders.parquet")


def _text(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_only_facts_that_may_be_kept_are_sorted(spark, tmp_path, monkeypatch):
    """The facts that are kept are those of a sort of all facts, of which the sort gets those of their key's greatest rank."""
    _odd_orders(spark, tmp_path)
    plain, sizes = cleaning.dedup_facts, []
    monkeypatch.setattr(cleaning, "dedup_facts", lambda facts: (sizes.append(facts.count()), plain(facts))[1])
    for sf_dir in (SF, str(tmp_path)):
        d = Data(spark, sf_dir)
        assert _text(d.unique) == _text(plain(d.classified))
    made = spark.read.parquet(f"{tmp_path}/orders.parquet").count()
    assert made > 6000 and sizes[-1] < made / 4, sizes


def test_months_are_made_from_rows_that_more_orders_do_not_add_to(spark, tmp_path, monkeypatch):
    """A row a day, priority and status, with the same months as from all orders."""
    once, often = str(tmp_path / "once"), str(tmp_path / "often")
    _odd_orders(spark, once)
    orders = spark.read.parquet(f"{once}/orders.parquet")
    orders.crossJoin(spark.range(5).select("id")).withColumn("o_orderkey", F.col("o_orderkey") + F.col("id") * 10000).drop("id").coalesce(2).write.parquet(f"{often}/orders.parquet")
    view, sizes = proxies.view, []
    monkeypatch.setattr(proxies, "view", lambda s, d, name: (sizes.append(s.read.parquet(f"{d}/orders.parquet").count()), view(s, d, name))[1])
    for sf_dir in (SF, once, often):
        plain, ours = view(spark, sf_dir, "macro"), Data(spark, sf_dir).px("macro")
        assert [(f.name, f.dataType) for f in plain.schema] == [(f.name, f.dataType) for f in ours.schema]
        assert _text(plain) == _text(ours) and plain.count() > 0
    assert sizes[1] == sizes[2] <= orders.count(), sizes


def test_one_fact_of_a_key_as_by_its_plain_order(spark):
    rng = random.Random(3)
    day = lambda: rng.choice([None, datetime.date(1960, 1, 1), datetime.date(1999, 3, 31), datetime.date(1999, 6, 30)])
    rows = [(i, rng.choice(["A", "B", None]), rng.choice(["X", "Y"]), day(), day(), rng.choice([None, -1.0, 0.0, 2.0, float("nan")]), rng.choice(["cumulative", "discrete", "snapshot", None])) for i in range(3000)]
    facts = spark.createDataFrame(rows, "fact_id long, ticker string, concept string, end_date date, filing_date date, value double, value_source string").repartition(3)
    plain = dedup_by(facts, ["ticker", "concept", "end_date"], [(F.col("value_source") == "cumulative").asc(), F.col("filing_date").desc_nulls_last(), F.col("value").desc_nulls_last(), F.col("fact_id").asc()])
    ours = cleaning.dedup_facts(facts)
    assert ours.columns == facts.columns and sorted(r.fact_id for r in ours.collect()) == sorted(r.fact_id for r in plain.collect())
    assert "_hash" in ours._jdf.queryExecution().optimizedPlan().toString()  # not sorted by the strings first
