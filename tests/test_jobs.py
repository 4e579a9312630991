import datetime as dt
import json

from fundalake.plans import jobs
from fundalake.sources.store import Store


def test_from_files_to_labels(spark, tmp_path):
    raw = tmp_path / "raw"
    for name in ("prices", "financials", "macro", "dividends", "sectors", "shares", "company_status"):
        (raw / name).mkdir(parents=True)
    days = [dt.date(2020, m, 1) for m in range(1, 13)]
    (raw / "prices/prices_1.csv").write_text("Date,Ticker,Open,High,Low,Close,Volume\n" + "".join(f"{d},A,1,3,1,{10 + i},5\n" for i, d in enumerate(days)))
    facts = [{"concept": c, "unit": "USD", "start": s, "end": e, "value": v, "form": "10-Q", "filing_date": f} for c, s, e, v, f in (("Revenues", "2020-01-01", "2020-03-31", 100.0, "2020-05-15"), ("Revenues", "2020-01-01", "2020-06-30", 250.0, "2020-08-14"), ("Assets", None, "2020-03-31", 1000.0, "2020-05-15"), ("Assets", None, "2020-06-30", 1100.0, "2020-08-14"))]
    (raw / "financials/A.json").write_text(json.dumps({"ticker": "A", "financials": facts}))
    (raw / "macro/unemployment_rate_usa.csv").write_text("date,value\n2020-01-01,4\n2020-05-01,13\n")
    (raw / "dividends/d.csv").write_text("Ticker,Date,Dividend\nA,2020-07-10,0.5\n")
    (raw / "sectors/s.csv").write_text("Ticker,Sector,Industry\nA,Tech,Chips\n")
    (raw / "shares/A.json").write_text(json.dumps({"ticker": "A", "shares_history": [{"end": "2020-03-31", "filed": "2020-05-15", "fy": "2020", "fp": "Q1", "value": 50, "source_type": "SEC_DEI"}]}))
    (raw / "company_status/s.csv").write_text("ticker,cik,status,delisting_date,delisting_form,last_filing_date,last_financial_report_date\nA,1,ACTIVE,,,2020-08-14,2020-08-14\n")
    store = Store(spark, f"file://{tmp_path}/store")
    counts = jobs.update(spark, store, f"file://{raw}", dt.date(2021, 1, 1))
    assert counts == {"prices": 12, "financials": 4, "macro": 2, "dividends": 1, "sectors": 1, "shares_outstanding": 1, "company_status": 1}
    rows = {r.date: r for r in store.read("bankruptcy_dataset").collect()}
    assert sorted(rows) == [dt.date(2020, m, 1) for m in (6, 7, 8, 9)]
    june, july, september = rows[dt.date(2020, 6, 1)], rows[dt.date(2020, 7, 1)], rows[dt.date(2020, 9, 1)]
    assert (june.Revenues, june.Assets, june.close, june.shares_outstanding, june.unemp_level) == (100.0, 1000.0, 15.0, 50, 13.0)
    assert (september.Revenues, september.Assets, july.dividend_amount, june.sector, june.target_bankruptcy) == (150.0, 1100.0, 0.5, "Tech", 0)
    assert jobs.update(spark, store, f"file://{raw}", dt.date(2021, 1, 1)) == counts
    jobs.analyse(store, f"file://{tmp_path}/out", ["A"])
    assert spark.read.option("header", True).csv(f"file://{tmp_path}/out/describe").count() == 5
