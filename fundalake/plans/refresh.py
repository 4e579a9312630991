"""The derived tables, kept up to date by what has changed in the tables that they are made of.

A derived table records the version of each source that it was made of, and the
day for which.  At a refresh it asks every source for its change set since then,
reduces that to the units its own step works on (keys of rows, or companies),
makes those again and puts them in place of the old ones, so only folders that
hold them are written.  Its own change set has the rows that came out different,
and is what the next step asks for: a price in the middle of a month ends at the
clean prices.

Macro figures concern all companies of a country, but only from the month on in
which the first changed one is published; those rows get their macro columns
anew.  A later day lets reports through that were too far ahead; their companies
are made again.

A table is built as a whole if it is not there, has no record of a source, or if
a source was replaced or has changed more often than it remembers.  A refresh
that dies goes on at the step where it was.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.operators import cleaning, labels, master
from fundalake.plans.constants import MACRO
from fundalake.sources.store import Layout, Store

#: Buckets of the tables that are made company by company.
BUCKETS = 64
_BY_TICKER = Layout("bucket", "ticker", BUCKETS)


class Step(NamedTuple):
    """A derived table: its sources, how it is made of them, the columns of the units that are made again, its keys and layout."""

    target: str
    sources: tuple[str, ...]
    make: Callable[..., DataFrame]
    unit: tuple[str, ...]
    keys: tuple[str, ...]
    layout: Layout | None


STEPS = (
    Step("macro_normalized", ("macro",), cleaning.normalize_macro, (), ("period_date", "country", "publication_date"), Layout("year", "period_date")),
    Step("prices_cleaned", ("prices",), cleaning.clean_prices, ("ticker", "date", "country"), ("ticker", "date", "country"), Layout("year", "date")),
    Step("dividends_cleaned", ("dividends",), cleaning.clean_dividends, ("ticker", "dividend_date", "country"), ("ticker", "dividend_date", "country"), Layout("year", "dividend_date")),
    Step("sectors_cleaned", ("sectors",), cleaning.clean_sectors, ("ticker",), ("ticker", "country"), _BY_TICKER),
    Step("shares_cleaned", ("shares_outstanding",), cleaning.clean_shares, ("ticker",), ("ticker", "filing_date"), _BY_TICKER),
    Step("financials_cleaned", ("financials",), lambda f: cleaning.quarterly(cleaning.fill_facts(f)), ("ticker",), ("ticker", "concept", "end_date"), _BY_TICKER),
    Step("financials_wide", ("financials_cleaned",), lambda f: cleaning.wide(cleaning.redate(f)), ("ticker",), ("ticker", "end_date"), _BY_TICKER),
)
_MASTER = ("financials_wide", "prices_cleaned", "sectors_cleaned", "shares_cleaned", "dividends_cleaned", "macro_normalized")
_MASTER_KEYS = ("ticker", "date")


def _changed(store: Store, target: str, sources: Sequence[str], now: dict[str, int]) -> dict[str, DataFrame] | None:
    """What has changed in each source since ``target`` was made; None if it must be built."""
    if not store.exists(target):
        return None
    made_of = store.version(target).sources
    if any(s not in made_of for s in sources):
        return None
    found = {s: store.changes(s, int(made_of[s])) if made_of[s] != now[s] else None for s in sources}
    if any(found[s] is None and made_of[s] != now[s] for s in sources):
        return None
    return {s: c for s, c in found.items() if c is not None and not c.isEmpty()}


def _units(changed: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    return reduce(DataFrame.unionByName, [c.select(*columns) for c in changed]).distinct()


def _bring(store: Store, step: Step) -> str:
    now = {s: store.version(s).number for s in step.sources}
    changed = _changed(store, step.target, step.sources, now)
    if changed is not None and not changed:
        return "kept"
    if changed is None:
        store.write(step.target, step.make(*[store.read(s, now[s]) for s in step.sources]), step.keys, layout=step.layout, sources=now)
        return "built"
    if not step.unit:  # some hundred rows, of which each may depend on those a year before
        rows = step.make(*[store.read(s, now[s]) for s in step.sources])
        store.patch(step.target, rows, store.read(step.target).select(*step.keys), step.keys, layout=step.layout, sources=now)
        return "patched"
    units = _units(list(changed.values()), step.unit)
    store.patch(step.target, step.make(*[store.holding(s, units, now[s]) for s in step.sources]), units, step.keys, layout=step.layout, sources=now)
    return "patched"


def _horizon(wide: DataFrame, days: Sequence[datetime.date]) -> DataFrame:
    """Companies with reports that one of the days lets through and the other does not."""
    far = F.greatest("filing_date", "end_date")
    low, high = (F.add_months(F.lit(d), 12) for d in (min(days), max(days)))
    return wide.filter((far > low) & (far <= high)).select("ticker").distinct()


def _bring_master(store: Store, as_of: datetime.date) -> str:
    target, now = "master_dataset", {s: store.version(s).number for s in _MASTER}
    mark = {"as_of": as_of.isoformat()}
    read = lambda s: store.read(s, now[s])
    changed = _changed(store, target, _MASTER, now)
    if changed is None or "as_of" not in store.version(target).sources:
        rows = master.build(*[read(s) for s in _MASTER], as_of)
        store.write(target, rows, _MASTER_KEYS, layout=_BY_TICKER, sources=now | mark)
        return "built"
    before = store.version(target).sources
    macro = changed.pop("macro_normalized", None)
    if macro is not None:
        # (country, first month): a row a country
        since = macro.groupBy(F.col("country").alias("_country")).agg(F.min("publication_date").alias("_since"))
        old = store.read(target)
        rows = old.join(since, (F.col("country") == F.col("_country")) & (F.col("date") >= F.col("_since")), "left_semi")
        again = master.with_macro(rows.drop(*MACRO), read("macro_normalized")).select(*old.columns)
        store.patch(target, again, None, _MASTER_KEYS, layout=_BY_TICKER, sources=before | {"macro_normalized": now["macro_normalized"]})
    units = [_units(list(changed.values()), ["ticker"])] if changed else []
    if before["as_of"] != mark["as_of"]:
        units.append(_horizon(read("financials_wide"), [as_of, datetime.date.fromisoformat(str(before["as_of"]))]))
    if not units:
        return "patched" if macro is not None else "kept"
    companies = _units(units, ["ticker"])
    parts = [store.holding(s, companies, now[s]) for s in _MASTER[:-1]]
    store.patch(target, master.build(*parts, read("macro_normalized"), as_of), companies, _MASTER_KEYS, layout=_BY_TICKER, sources=now | mark)
    return "patched"


def _bring_labels(store: Store) -> str:
    target = "bankruptcy_dataset"
    sources = ["master_dataset", *(["company_status"] if store.exists("company_status") else [])]
    now = {s: store.version(s).number for s in sources}
    changed = _changed(store, target, sources, now)
    if changed is not None and not changed:
        return "kept"
    if changed is None:
        made = labels.build(store.read(sources[0], now[sources[0]]), store.read(sources[1], now[sources[1]]) if sources[1:] else None)
        store.write(target, made, _MASTER_KEYS, layout=_BY_TICKER, sources=now)
        return "built"
    companies = _units(list(changed.values()), ["ticker"])
    parts = [store.holding(s, companies, now[s]) for s in sources]
    store.patch(target, labels.build(parts[0], parts[1] if parts[1:] else None), companies, _MASTER_KEYS, layout=_BY_TICKER, sources=now)
    return "patched"


def refresh(store: Store, as_of: datetime.date) -> dict[str, str]:
    """Bring all derived tables up to date; for each whether it was built, patched or kept as it was."""
    out = {step.target: _bring(store, step) for step in STEPS}
    out["master_dataset"] = _bring_master(store, as_of)
    out["bankruptcy_dataset"] = _bring_labels(store)
    return out
