"""Hand-made tables for the places where results are easily wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fundalake.operators import cleaning, labels, landing, master, screener, stats
from fundalake.operators.asof import asof_join
from fundalake.sources.store import Store, upsert

D = dt.date


def facts(spark, rows):
    full = [(t, c, "US", "USD", s, e, float(v), f, d, i) for i, (t, c, s, e, v, f, d) in enumerate(rows)]
    return spark.createDataFrame(full, "ticker string, concept string, country string, unit string, start_date date, end_date date, value double, form string, filing_date date, fact_id long")


def quarters(spark, rows):
    f = cleaning.quarterly(cleaning.fill_facts(cleaning.dedup_facts(cleaning.classify_period(facts(spark, rows)))))
    return {(r.ticker, r.concept, r.end_date): r for r in f.collect()}


def test_ytd(spark):
    y = D(2020, 1, 1)
    rows = [("A", "Revenues", y, e, v, "10-Q", None) for e, v in ((D(2020, 3, 31), 10), (D(2020, 6, 30), 25), (D(2020, 9, 30), 45), (D(2020, 12, 31), 70))]
    rows += [("B", "Revenues", s, e, v, "10-Q", None) for s, e, v in ((y, D(2020, 3, 31), 10), (D(2020, 4, 1), D(2020, 6, 30), 15), (D(2020, 7, 1), D(2020, 9, 30), 20), (y, D(2020, 12, 31), 70))]
    rows += [("C", "Revenues", y, D(2020, 12, 31), 70, None, None), ("D", "Revenues", D(2019, 10, 1), D(2020, 9, 30), 5, "10-K", None)]
    q = quarters(spark, rows)
    assert [q["A", "Revenues", D(2020, m, d)].value_quarterly for m, d in ((3, 31), (6, 30), (9, 30), (12, 31))] == [10, 15, 20, 25]
    assert q["A", "Revenues", D(2020, 12, 31)].fiscal_quarter == "4" and q["A", "Revenues", D(2020, 6, 30)].value_quarterly_source == "calculated"
    # the year minus the row before, whatever that is
    assert q["B", "Revenues", D(2020, 12, 31)].value_quarterly == 50
    assert q["C", "Revenues", D(2020, 12, 31)].fiscal_quarter == "FY" and q["C", "Revenues", D(2020, 12, 31)].form == "forecasted"
    assert q["C", "Revenues", D(2020, 12, 31)].filing_date == D(2021, 1, 31)
    assert q["A", "Revenues", D(2020, 3, 31)].year_complete and not q["C", "Revenues", D(2020, 12, 31)].year_complete


def test_snapshots_move_to_flows(spark):
    flow = [("A", "Revenues", D(2020, 1, 1), D(2020, 3, 31), 1, "10-Q", None), ("A", "Revenues", D(2021, 4, 1), D(2021, 6, 30), 2, "10-Q", None)]
    snap = [("A", "Assets", None, d, 3, None, None) for d in (D(2020, 3, 31), D(2020, 3, 1), D(2020, 6, 29), D(2021, 7, 1))] + [("B", "Assets", None, D(2020, 3, 31), 3, None, None)]
    clean = cleaning.quarterly(cleaning.fill_facts(cleaning.classify_period(facts(spark, flow + snap))))
    moved = {(r.ticker, r.snapshot_date): r.flow_date for r in cleaning.snapshot_to_flow(clean).collect()}
    # 2020-06-29 is 366 days before the next flow
    assert moved == {("A", D(2020, 3, 31)): D(2020, 3, 31), ("A", D(2020, 3, 1)): D(2020, 3, 31)}
    wide = cleaning.wide(cleaning.redate(clean)).collect()
    assert {(r.ticker, r.end_date, r.Assets) for r in wide} == {("A", D(2020, 3, 31), 3.0), ("A", D(2021, 6, 30), None)}


@pytest.mark.parametrize("plan", ["interval", "window"])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof(spark, plan, direction):
    left = spark.createDataFrame([("a", D(2020, 1, i)) for i in (1, 5, 9)] + [("b", D(2020, 1, 5)), (None, D(2020, 1, 5)), ("a", None)], "k string, d date")
    right = spark.createDataFrame([("a", D(2020, 1, 5), 1, "x"), ("a", D(2020, 1, 5), 2, "y"), ("a", D(2020, 1, 8), None, None), ("a", None, 9, "z"), (None, D(2020, 1, 5), 7, "n")], "k string, at date, v int, s string")
    out = {(r.k, r.d): r.m for r in asof_join(left, right, ["k"], "d", "at", direction, tie=[F.col("v").desc_nulls_last()], plan=plan, match="m").collect()}
    assert len(out) == 6
    got = {k: m and (m.at.day, m.v) for k, m in out.items()}
    want = {1: None, 5: (5, 2), 9: (8, None)} if direction == "backward" else {1: (5, 2), 5: (5, 2), 9: None}
    assert {d.day: got["a", d] for k, d in got if k == "a" and d} == want
    assert got["b", D(2020, 1, 5)] is None and got[None, D(2020, 1, 5)] is None and got["a", None] is None


def test_publication_gap(spark):
    days = [D(2023, 1, 1), D(2023, 1, 31), D(2023, 2, 28), D(2023, 5, 31), D(2023, 6, 30), D(2023, 7, 31), D(2023, 12, 31)]
    wide = spark.createDataFrame([("A", "US", d, d) for d in days], "ticker string, country string, end_date date, filing_date date")
    assert {r.filing_date for r in master.published(wide, D(2024, 1, 1)).collect()} == {days[0], days[1], days[3]}


def test_stale_reports(spark):
    rows = spark.createDataFrame([("A", "US", D(2020, 1, 1), D(2019, 12, 31))], "ticker string, country string, publication_date date, end_date date")
    rows = rows.withColumns({c: F.lit(1.0) for c in master.CONCEPTS} | {"filing_date": F.col("end_date"), "fiscal_quarter": F.lit("4")})
    spine = spark.createDataFrame([("A", "US", d) for d in (D(2020, 5, 30), D(2020, 5, 31))], "ticker string, country string, date date")
    assert {r.date: r.Assets for r in master.with_reports(spine, rows).collect()} == {D(2020, 5, 30): 1.0, D(2020, 5, 31): None}


def filings(spark, forms):
    return spark.createDataFrame([(c, i, f, D.fromisoformat(d), None) for c, rows in forms.items() for i, (f, d) in enumerate(rows)], "cik string, pos int, form string, filing_date date, report_date date")


def test_status(spark):
    rows = {"gone": [("25-NSE", "2023-05-01"), ("10-K", "2023-02-01")], "off": [("10-K", "2023-02-01"), ("15-12G", "2023-01-01")], "old": [("10-Q", "2020-01-01"), ("8-K", "2023-12-01")], "none": [("8-K", "2023-12-01")], "well": [("8-K", "2023-12-01"), ("10-K", "2023-11-01")]}
    payloads = landing.submissions(filings(spark, rows)).unionByName(spark.createDataFrame([("bad", "{"), ("empty", '{"filings":{"recent":{"form":[],"filingDate":[],"reportDate":[]}}}')], "cik string, payload string"))
    got = {r.cik: (r.status, r.delisting_date) for r in landing.filing_status(payloads, D(2024, 1, 1)).collect()}
    assert got == {"gone": ("DELISTED", D(2023, 5, 1)), "off": ("DEREGISTERED", D(2023, 1, 1)), "old": ("ZOMBIE", None), "none": ("ZOMBIE", None), "well": ("ACTIVE", None), "bad": ("ERROR", None), "empty": ("UNKNOWN", None)}


def one(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_text_parsers(spark):
    assert one(spark, landing.cik_of, ["1487197", "0001487197", "320193", "  1487197  ", "12345678901"]) == ["0001487197", "0001487197", "0000320193", "0001487197", "12345678901"]
    heads = one(spark, landing.period_header, ["2019/Q3(wrz 19)", "2020/Q1(mar 20)", "2023 (gru 23)", "2023 (wrz 23)", "2024 (K4 wrz 24)", "junk"])
    assert [h and tuple(h) for h in heads] == [("2019-09-30", "Q3"), ("2020-03-31", "Q1"), ("2023-12-31", "Annual"), ("2023-09-30", "Annual"), ("2024-09-30", "Q4"), None]
    assert one(spark, landing.local_number, ["620 186", "620 186", "12,34", "-", "", "5 tys. PLN", "junk", None]) == [620186000.0, 620186000.0, 12340.0, None, None, 5000.0, None, None]
    assert one(spark, landing.period_date, ["2020", "2020-02", "2020-Q3", "2020-05-06", "x"]) == [D(2020, 1, 1), D(2020, 2, 1), D(2020, 7, 1), D(2020, 5, 6), None]


def test_upsert_with_null_keys(spark):
    kind = "k string, s date, v int"
    old = spark.createDataFrame([("a", None, 1), ("b", D(2020, 1, 1), 2)], kind)
    new = spark.createDataFrame([("a", None, 3), ("c", None, 4), ("c", None, 5)], kind)
    assert sorted(tuple(r)[::2] for r in upsert(old, new, ["k", "s"]).collect()) == [("a", 3), ("b", 2), ("c", 4), ("c", 5)]
    assert sorted(tuple(r)[::2] for r in upsert(old, new, ["k", "s"], [F.col("v").desc()]).collect()) == [("a", 3), ("b", 2), ("c", 5)]


def test_masks(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    n = lambda op, *v: df.filter(screener.Condition("x", op, *v).to_column()).count()
    assert [n("<", 2), n("<=", 2), n(">", 1), n(">=", 1), n("==", 1), n("!=", 1), n("between", 1, 2), n("in", [1.0]), n("not_in", [1.0]), n("is_null"), n("not_null")] == [1, 2, 1, 2, 1, 2, 2, 1, 2, 1, 2]


def test_moments(spark):
    k = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double").agg(stats.skew("x"), stats.kurt("x")).first()
    assert tuple(k([1, 2])) == (None, None)
    assert k([1, 2, 4])[0] is not None and k([1, 2, 4])[1] is None
    assert round(k([1, 2, 10, 4, 3])[1], 3) == 3.152


def test_trend(spark):
    data = {"none": [None, None], "one": [1.0], "up": [1.0, 2.0], "odd": [10.0, 99.0, 10.4], "zero": [0.0, 5.0], "edge": [1.0, 1.05 - 1e-12], "down": [2.0, 1.0]}
    rows = [(t, D(2020, 1, i + 1), x) for t, v in data.items() for i, x in enumerate(v)]
    got = {r.ticker: r.x_trend for r in screener.trend(spark.createDataFrame(rows, "ticker string, date date, x double"), "x").collect()}
    assert got == {"none": None, "one": None, "up": "rising", "odd": "stable", "zero": "stable", "edge": "stable", "down": "falling"}


def test_distress(spark):
    base = {c: 1.0 for c in ("Assets", "Liabilities", "AssetsCurrent", "LiabilitiesCurrent", "RetainedEarnings", "OperatingIncomeLoss", "Revenues", "NetIncomeLoss", "OperatingCashFlow", "StockholdersEquity", "debt_ratio", "current_ratio")}
    base |= {"debt_ratio": 0.5, "current_ratio": 2.0}
    rows = [dict(base, ticker=t, date=D(2020, i + 1, 1), StockholdersEquity=e, NetIncomeLoss=n) for t, v in {"always": [(-1.0, -1.0)] * 2, "once": [(-1.0, -1.0), (1.0, -1.0)], "undated": [(-1.0, -1.0)]}.items() for i, (e, n) in enumerate(v)]
    m = spark.createDataFrame(rows)
    status = spark.createDataFrame([("always", "DELISTED", D(2021, 1, 1)), ("once", "DELISTED", D(2021, 1, 1)), ("undated", "DELISTED", None)], "ticker string, status string, delisting_date date")
    c = labels.censor(m, status)
    assert {r.ticker for r in c.collect()} == {"always", "once"}
    votes = {r.ticker: r.distress_signals for r in labels.distress_votes(labels.distress_profile(c)).collect()}
    assert votes == {"always": 2, "once": 1}
    target = {(r.ticker, r.target_bankruptcy) for r in labels.with_target(c, labels.distress_votes(labels.distress_profile(c))).collect()}
    assert target == {("always", 1), ("once", 0)}


def test_no_look_ahead(spark):
    from fundalake.plans.registry import Data

    d = Data(spark, "/root/testdata/sf0.001")
    late = d.carried.filter("filing_date > date").count()
    months = d.master.groupBy("ticker", "date").count().filter("count > 1").count()
    assert (late, months) == (0, 0)


def test_store_and_stream(spark, tmp_path):
    from fundalake.streaming.ingest import ingest

    store, landed = Store(spark, f"file://{tmp_path}/store"), f"file://{tmp_path}/landed"
    kind = "ticker string, date date, country string, open double, high double, low double, close double, volume bigint"
    write = lambda rows: spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(landed)
    order = [F.col("close").desc()]
    run = lambda: ingest(spark, store, "prices", landed, f"file://{tmp_path}/ck", order)
    write([("A", D(2020, 1, 1), "US", 1.0, 1.0, 1.0, 1.0, 1), ("B", D(2020, 1, 1), "US", 1.0, 1.0, 1.0, 1.0, 1)])
    assert run() == 1 and store.read("prices").count() == 2
    write([("A", D(2020, 1, 1), "US", 1.0, 1.0, 1.0, 7.0, 1)])
    assert run() == 1
    assert sorted((r.ticker, r.close) for r in store.read("prices").collect()) == [("A", 7.0), ("B", 1.0)]
    assert run() == 0
    assert [tuple(r) for r in store.catalog().collect()] == [("prices", 2)]
    assert store.sql("SELECT count(*) AS n FROM prices WHERE close > ?", [2.0]).first().n == 1


def test_upsert_touches_only_its_years(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    frame = lambda rows: spark.createDataFrame(rows, "k string, d date, year_of_d string, v int")
    put = lambda rows, **more: store.upsert("t", frame(rows), ["k", "d"], **more)
    got = lambda: sorted((r.k, str(r.d), r.v) for r in store.read("t").collect())
    years = lambda: {f.rsplit("=", 1)[1]: f for f in store.folders("t")}
    put([])
    assert got() == [] and store.read("t").columns == ["k", "d", "year_of_d", "v"]
    put([("a", D(2020, 1, 1), "x", 1), ("b", D(2021, 5, 1), "x", 2), ("c", None, "x", 3), (None, D(2021, 5, 1), "x", 4)])
    before = years()
    assert set(before) == {"2020", "2021", "none"}
    put([("b", D(2021, 5, 1), "y", 5), ("b", D(2021, 6, 1), "y", 6), (None, D(2021, 5, 1), "y", 7)])
    now = years()
    assert now["2020"] == before["2020"] and now["none"] == before["none"] and now["2021"] != before["2021"]
    want = [("None", "2021-05-01", 7), ("a", "2020-01-01", 1), ("b", "2021-05-01", 5), ("b", "2021-06-01", 6), ("c", "None", 3)]
    assert sorted((str(k), d, v) for k, d, v in ((r.k, str(r.d), r.v) for r in store.read("t").collect())) == want
    put([("c", None, "z", 8), ("e", D(2022, 1, 1), "z", 9), ("e", D(2022, 1, 1), "z", 1)], order_by=[F.col("v").desc()])
    put([])
    assert sorted((r.v for r in store.read("t").collect())) == [1, 5, 6, 7, 8, 9]
    # two versions stay, and no folder that neither of them names
    folders = [f for f in (tmp_path / "store/t/data").glob("*/*") if f.is_dir()]
    assert len(list((tmp_path / "store/t/versions").iterdir())) == 2 and len(folders) == 4
    assert store.size().first().n_bytes > 0
    # a table written as a whole is dealt by years at its first upsert
    store.write("w", store.read("t").select("k", "d", "v"))
    store.upsert("w", spark.createDataFrame([("a", D(2020, 1, 1), 10)], "k string, d date, v int"), ["k", "d"])
    assert sorted(r.v for r in store.read("w").collect()) == [5, 6, 7, 8, 9, 10] and len(store.folders("w")) == 4


def test_staged_again_when_the_source_changes(spark, tmp_path):
    from fundalake.sources.staging import staged

    source, made = f"file://{tmp_path}/in", []

    def make():
        made.append(1)
        return spark.range(len(made))

    spark.range(1).write.parquet(f"{source}/t.parquet")
    assert [staged(spark, source, "x", make).count() for _ in range(2)] == [1, 1]
    spark.range(2).write.mode("append").parquet(f"{source}/t.parquet")
    assert [staged(spark, source, "x", make).count() for _ in range(2)] == [2, 2]


def test_high_water_marks_by_country(spark):
    from fundalake.operators.landing import high_water_marks

    rows = spark.createDataFrame([("A", D(2020, 1, 10), "US"), ("A", D(2020, 3, 10), "PL")], "ticker string, date date, country string")
    universe = spark.createDataFrame([("A",), ("B",)], "ticker string")
    mark = lambda c: {r.ticker: r.start_date for r in high_water_marks(universe, rows, "date", 1, D(1990, 1, 1), c).collect()}
    assert mark(None) == {"A": D(2020, 3, 9), "B": D(1990, 1, 1)} and mark("US")["A"] == D(2020, 1, 9)


def test_file_scans(spark, tmp_path):
    from fundalake.sources import files

    (tmp_path / "p").mkdir()
    (tmp_path / "p/prices_2020.csv").write_text("Date,Ticker,Open,High,Low,Close,Volume\n2020-01-01,OLD,1,1,1,1,1\n")
    (tmp_path / "p/prices_2021.csv").write_text("Date,Ticker,Open,High,Low,Close,Volume\n2021-01-01,A,1,2,1,1.5,10\nbad,A,1,2,1,1.5,10\n")
    (tmp_path / "p/prices_pl_2021.csv").write_text("Date,Ticker,Open,High,Low,Close,Volume\n2021-01-01,B.PL,1,2,1,x,10\n")
    assert sorted((r.ticker, r.country, r.close) for r in files.prices(spark, f"{tmp_path}/p").collect()) == [("A", "US", 1.5), ("B.PL", "PL", None)]
    (tmp_path / "f").mkdir()
    (tmp_path / "f/A.json").write_text('{"ticker":"A","financials":[{"concept":"Assets","unit":"USD","end":"2020-03-31","value":5.0,"form":"10-Q"}]}')
    (tmp_path / "f/B.PL.json").write_text('[{"concept":"Assets","unit":"PLN","end":"2020-03-31","value":6.0}]')
    assert sorted((r.ticker, r.country, r.value, r.value_source) for r in files.financials(spark, f"{tmp_path}/f").collect()) == [("A", "US", 5.0, "snapshot"), ("B.PL", "PL", 6.0, "snapshot")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m/cpi.csv").write_text("date,value\n2020-01-01,1\n2020-02-01,.\n")
    (tmp_path / "m/gdp.csv").write_text("date,value\n2020-02-01,3\n")
    got = {r.date: (r.inflation_usa, r.gdp_real_usa) for r in files.macro(spark, f"{tmp_path}/m", {"cpi.csv": "inflation_usa", "gdp.csv": "gdp_real_usa"}).collect()}
    assert got == {D(2020, 1, 1): (1.0, None), D(2020, 2, 1): (None, 3.0)}
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.csv").write_text("Ticker,Sector,Industry\nA,Tech,Chips\nC.PL,Energy,Oil\n")
    (tmp_path / "s/b.csv").write_text("Ticker,Sector,Industry\nA,Health,Drugs\n")
    assert sorted((r.ticker, r.country, r.sector) for r in files.sectors(spark, f"{tmp_path}/s").collect()) == [("A", "US", "Health"), ("C.PL", "PL", "Energy")]
    (tmp_path / "c.json").write_text('{"companies":[{"cik":"1","name":"X","sic":"","all_tickers":["A","B"],"exchanges":["N"]},{"cik":"2","name":"Y","sic":"3571","all_tickers":["C"],"exchanges":[]}]}')
    assert sorted((r.cik, r.ticker, r.sic, r.exchange) for r in files.company_metadata(spark, f"{tmp_path}/c.json").collect()) == [("1", "A", None, "N"), ("1", "B", None, "N"), ("2", "C", 3571, None)]


def test_full_settings_of_the_model_queries(spark, monkeypatch):
    from fundalake.plans import registry

    rows, built = spark.range(37), []
    monkeypatch.setattr(registry, "_sides", lambda d: (rows, rows, ["id"]))
    monkeypatch.setattr(registry.models, "train", lambda pipeline, df: built.append(pipeline.getStages()[-1]))
    monkeypatch.setattr(registry.models, "score", lambda model, df: df.selectExpr("id AS ticker", "id AS date", "0 AS target_bankruptcy", "0D AS score"))
    for build in (registry._logistic, lambda t, c: registry.models.random_forest(c), lambda t, c: registry.models.boosted_trees(c)):
        registry._scored(None, build)
    logistic, forest, boosted = built
    assert logistic.getRegParam() == 1 / 37 and logistic.getMaxIter() == 1000
    assert (forest.getNumTrees(), forest.getMaxDepth(), boosted.getMaxIter(), boosted.getMaxDepth()) == (300, 10, 300, 6)
