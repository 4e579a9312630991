"""The store under change: change sets, two writers, added columns; and derived tables that follow what has changed."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from fundalake.plans import refresh as plan
from fundalake.plans.refresh import refresh
from fundalake.sources.store import Layout, Store

D = dt.date


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store", patience=30)


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_change_sets(spark, store):
    put = lambda rows: store.upsert("t", spark.createDataFrame(rows, "k string, d date, v int"), ["k", "d"])
    put([("a", D(2020, 1, 1), 1), ("b", D(2020, 1, 1), 2), (None, D(2021, 1, 1), 3)])
    assert store.changes("t", 0).collect() == [] and store.changes("t", -1) is None
    put([("a", D(2020, 1, 1), 1), ("b", D(2020, 1, 1), 5)])  # a is what it was
    put([(None, D(2021, 1, 1), 4), ("c", D(2022, 1, 1), 1)])
    assert rows_of(store.changes("t", 0)) == sorted(["('b', datetime.date(2020, 1, 1))", "(None, datetime.date(2021, 1, 1))", "('c', datetime.date(2022, 1, 1))"])
    assert rows_of(store.changes("t", 1)) == sorted(["(None, datetime.date(2021, 1, 1))", "('c', datetime.date(2022, 1, 1))"])
    store.patch("t", store.read("t").limit(0), spark.createDataFrame([("b",)], "k string"), ["k", "d"])  # gone, nothing instead
    assert rows_of(store.changes("t", 2)) == ["('b', datetime.date(2020, 1, 1))"] and store.read("t").count() == 3
    store.write("t", store.read("t"))
    assert store.changes("t", 3) is None and store.changes("t", 4).collect() == []


def test_two_writers_lose_nothing(spark, store):
    frame = lambda n, day: spark.createDataFrame([(f"{n}{i}", day, i) for i in range(20)], "k string, d date, v int")
    store.upsert("t", frame("x", D(2020, 1, 1)), ["k", "d"])
    failed = []

    def write(n):
        try:
            for i in range(3):
                store.upsert("t", frame(f"{n}{i}", D(2020, 1, 1)), ["k", "d"])
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(n,)) for n in "abc"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and store.read("t").count() == 20 * 10
    assert store.version("t").number == 9


def test_claim_of_a_dead_writer(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store", patience=0.5)
    put = lambda v: s.upsert("t", spark.createDataFrame([("a", v)], "k string, v int"), ["k"])
    put(1)
    assert s._claim("t", 1)  # and never makes the version
    put(2)
    assert s.version("t").number == 2 and [tuple(r) for r in s.read("t").collect()] == [("a", 2)]
    assert rows_of(s.changes("t", 0)) == ["('a',)"]


def test_added_and_wider_columns(spark, store):
    put = lambda rows, kind: store.upsert("t", spark.createDataFrame(rows, kind), ["k", "d"])
    put([("a", D(2020, 1, 1), 1), ("b", D(2021, 1, 1), 2)], "k string, d date, v int")
    put([("c", D(2021, 1, 1), 5_000_000_000, "new")], "k string, d date, v long, extra string")
    put([("d", D(2022, 1, 1))], "k string, d date")
    put([("e", D(2022, 1, 1), 7)], "k string, d date, v int")
    got = {r.k: (r.v, r.extra) for r in store.read("t").collect()}
    assert got == {"a": (1, None), "b": (2, None), "c": (5_000_000_000, "new"), "d": (None, None), "e": (7, None)}
    assert store.read("t").schema["v"].dataType.simpleString() == "bigint"
    assert len([f for f in store.folders("t") if f.endswith("2020")]) == 1  # the old folder is as it was, and read with the new columns
    with pytest.raises(ValueError, match="column v"):
        put([("f", D(2022, 1, 1), "text")], "k string, d date, v string")
    store.upsert("sectors", spark.createDataFrame([("A", "Tech", 3)], "ticker string, sector string, rank int"))
    assert store.read("sectors").first()["rank"] == 3 and store.read("sectors").columns[:3] == ["ticker", "country", "sector"]


def test_tables_without_dates_are_dealt_by_buckets(spark, store):
    put = lambda rows: store.upsert("sectors", spark.createDataFrame(rows, "ticker string, sector string"))
    put([(f"T{i}", "x") for i in range(200)] + [(None, "x")])
    before = set(store.folders("sectors"))
    assert len(before) == 17
    put([("T7", "y")])
    after = set(store.folders("sectors"))
    assert len(before & after) == 16 and len(after) == 17
    assert store.read("sectors").filter("sector = 'y'").first().ticker == "T7" and store.read("sectors").count() == 201


def test_reads_list_only_what_they_need(spark, store):
    rows = [(f"T{i % 9}", D(2000 + i % 20, 3, 1), float(i)) for i in range(180)]
    store.upsert("prices", spark.createDataFrame(rows, "ticker string, date date, close double"))
    got = store.select("prices", "date", ["T1"], "2003-02-01", "2005-12-31")
    assert {f.split("date=")[1][:4] for f in got.inputFiles()} == {"2003", "2004", "2005"}
    assert sorted((r.ticker, r.date, r.close) for r in got.collect()) == sorted(r for r in rows if r[0] == "T1" and 2003 <= r[1].year <= 2005)
    store.patch("by_ticker", spark.createDataFrame(rows, "ticker string, date date, close double"), None, ["ticker", "date"], layout=Layout("bucket", "ticker", 64))
    some = store.select("by_ticker", "date", ["T1", "T2"])
    assert len({f.rsplit("/", 1)[0] for f in some.inputFiles()}) == 2 and some.count() == 40


DAYS = [D(2018 + m // 12, 1 + m % 12, 1) for m in range(48)]


def landed(spark, store, tickers, change=lambda name, rows: rows):
    """All raw tables of some companies, with quarterly facts over four years."""
    quarters = [(D(y, 1 + 3 * q, 1), D(y, 3 + 3 * q, 30 if q in (1, 2) else 31), D(y + (q == 3), (5, 8, 11, 2)[q], 10)) for y in range(2018, 2022) for q in range(4)]
    facts = [(t, c, "US", "USD", a if c != "Assets" else None, b, float(100 * i + 7 * j + len(c)), "10-Q", f, "snapshot" if c == "Assets" else "discrete") for i, t in enumerate(tickers, 1) for j, (a, b, f) in enumerate(quarters) for c in ("Revenues", "NetIncomeLoss", "Assets", "Liabilities")]
    tables = {
        "prices": ([(t, d, "US", 1.0, 2.0, 0.5, 10.0 * i + d.month, 5) for i, t in enumerate(tickers, 1) for d in DAYS], "ticker string, date date, country string, open double, high double, low double, close double, volume long"),
        "financials": (facts, "ticker string, concept string, country string, unit string, start_date date, end_date date, value double, form string, filing_date date, value_source string"),
        "macro": ([(d, 2.0 + d.month, 100.0 + d.year) for d in DAYS], "date date, unemployment_rate_usa double, gdp_real_usa double"),
        "dividends": ([(t, D(2019, 7, 10), "US", 0.5) for t in tickers], "ticker string, dividend_date date, country string, dividend_amount double"),
        "sectors": ([(t, "US", "Tech", "Chips") for t in tickers], "ticker string, country string, sector string, industry string"),
        "shares_outstanding": ([(t, D(2018, 5, 15), "US", 50, 2018, "Q1") for t in tickers], "ticker string, filing_date date, country string, shares long, fiscal_year int, fiscal_period string"),
        "company_status": ([(t, "ACTIVE" if i % 3 else "DELISTED", None if i % 3 else D(2020, 6, 1)) for i, t in enumerate(tickers)], "ticker string, status string, delisting_date date"),
    }
    for name, (rows, kind) in tables.items():
        rows = change(name, rows)
        if rows:
            store.upsert(name, spark.createDataFrame(rows, kind))


DERIVED = [s.target for s in plan.STEPS] + ["master_dataset", "bankruptcy_dataset"]


def test_refresh_follows_changes(spark, tmp_path):
    tickers, day = [f"T{i}" for i in range(12)], D(2022, 6, 1)
    one, whole = Store(spark, f"file://{tmp_path}/one"), Store(spark, f"file://{tmp_path}/whole")
    landed(spark, one, tickers)
    assert set(refresh(one, day).values()) == {"built"}
    assert set(refresh(one, day).values()) == {"kept"}
    before = {t: set(one.folders(t)) for t in DERIVED}

    # a day's files of three companies
    def later(name, rows):
        rows = [r for r in rows if r[0] in ("T3", "T4", "T5")]
        if name == "financials":
            return [(*r[:6], r[6] + 1000, *r[7:]) for r in rows if r[5] == D(2021, 9, 30)]
        if name == "prices":
            return [(*r[:6], 999.0, r[7]) for r in rows if r[1] == D(2021, 12, 1)]
        return rows if name in ("sectors", "shares_outstanding") else []  # as they were

    landed(spark, one, tickers, later)
    how = refresh(one, day)
    assert {t for t, x in how.items() if x == "patched"} == {"prices_cleaned", "financials_cleaned", "financials_wide", "master_dataset", "bankruptcy_dataset"}
    buckets = Layout("bucket", "ticker", plan.BUCKETS).labels_of(["T3", "T4", "T5"])
    for t in DERIVED:
        gone = {f.rsplit("=", 1)[1] for f in before[t] - set(one.folders(t))}
        assert gone <= ({"2021"} if t == "prices_cleaned" else buckets) and bool(gone) == (how[t] == "patched")

    # macro figures of the last months, one company's status, and a later day
    landed(spark, one, tickers, lambda name, rows: [(d, 50.0, g) for d, u, g in rows if d >= D(2021, 3, 1)] if name == "macro" else [("T6", "DELISTED", D(2021, 1, 1))] if name == "company_status" else [])
    how = refresh(one, D(2022, 7, 1))
    assert {t for t, x in how.items() if x == "patched"} == {"macro_normalized", "master_dataset", "bankruptcy_dataset"}

    landed(spark, whole, tickers)
    landed(spark, whole, tickers, later)
    landed(spark, whole, tickers, lambda name, rows: [(d, 50.0, g) for d, u, g in rows if d >= D(2021, 3, 1)] if name == "macro" else [("T6", "DELISTED", D(2021, 1, 1))] if name == "company_status" else [])
    refresh(whole, D(2022, 7, 1))
    for t in DERIVED:
        assert rows_of(one.read(t)) == rows_of(whole.read(t)), t
    assert one.read("master_dataset").filter("unemp_level = 50").select("date").distinct().count() > 3


def test_a_later_day_lets_reports_through(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/s")
    landed(spark, s, ["A", "B"])
    refresh(s, D(2020, 1, 1))
    early = s.read("master_dataset").count()
    assert refresh(s, D(2020, 6, 1))["master_dataset"] == "patched" and s.read("master_dataset").count() > early
    whole = Store(spark, f"file://{tmp_path}/w")
    landed(spark, whole, ["A", "B"])
    refresh(whole, D(2020, 6, 1))
    assert rows_of(s.read("bankruptcy_dataset")) == rows_of(whole.read("bankruptcy_dataset"))


@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_sliced_asof_is_the_others(spark, direction):
    from fundalake.operators.asof import asof_join

    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.when(F.col("id") % 97 != 5, F.date_add(F.lit("2000-01-01"), (F.col("id") * 37 % 900).cast("int"))).alias("d"), F.col("id").alias("v"))
    right = spark.range(400).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 41 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), F.date_add(F.lit("2000-02-01"), (F.col("id") * 53 % 800).cast("int")).alias("at"), F.when(F.col("id") % 11 != 0, F.col("id")).alias("x"))
    run = lambda plan, **more: rows_of(asof_join(left, right, ["k"], "d", "at", direction, tie=[F.col("x").asc_nulls_last()], plan=plan, **more).select("k", "d", "v", "_match.at", "_match.x"))
    want = run("interval")
    assert want == run("window") and all(want == run("sliced", width=w) for w in (1, 31, 5000))
    numbers = lambda df, c: df.withColumn(c, F.unix_date(c) / 2)
    left, right = numbers(left, "d"), numbers(right, "at")
    assert run("window") == run("sliced", width=10)


def test_correlations_against_numpy(spark):
    import numpy as np

    from fundalake.operators.stats import correlations

    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 6)) * [1, 1e6, 1e-6, 1, 1, 1] + [0, 1e9, 0, 5, 0, 0]
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    gone = rng.random(x.shape) < 0.3
    gone[:200, 4], gone[200:, 5] = True, True  # no row has both
    rows = [[None if g else float(v) for v, g in zip(a, b)] + [7.1 if i % 2 else None] for i, (a, b) in enumerate(zip(x, gone))]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(7))).repartition(5)
    for method in ("pearson", "spearman", "kendall"):
        got = {(r.a, r.b): r.correlation for r in correlations(df, df.columns, method).collect()}
        assert len(got) == 21
        assert got["c4", "c5"] is None and got["c0", "c6"] is None  # no common rows; one that does not vary
        if method == "pearson":
            for i in range(4):
                for j in range(i + 1, 4):
                    both = ~gone[:, i] & ~gone[:, j]
                    assert abs(got[f"c{i}", f"c{j}"] - np.corrcoef(x[both, i], x[both, j])[0, 1]) < 1e-9
    assert "Generate" not in correlations(df, df.columns)._jdf.queryExecution().executedPlan().toString()
    assert len(correlations(df.limit(0), df.columns).collect()) == 21
