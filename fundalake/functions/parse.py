"""Column functions that read codes, numbers, dates and links out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundalake.plans import constants as K


def date_of(c) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


def cik_of(c: Column) -> Column:
    """Digits only, zeros in front up to ten; longer ones stay whole."""
    digits = F.regexp_replace(c.cast("string"), "[^0-9]", "")
    return F.when(F.length(digits) >= 10, digits).otherwise(F.lpad(digits, 10, "0"))


def period_date(p: Column) -> Column:
    """First day of YYYY, YYYY-MM, YYYY-Qn or YYYY-MM-DD."""
    year = F.substring(p, 1, 4).try_cast("int")
    quarter = F.regexp_extract(p, r"^\d{4}-?Q([1-4])$", 1)
    return (
        F.when(p.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
        .when(p.rlike(r"^\d{4}-?Q[1-4]$"), F.make_date(year, quarter.try_cast("int") * 3 - 2, F.lit(1)))
        .when(p.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(p, F.lit("-01")), "yyyy-MM-dd"))
        .otherwise(F.try_to_date(p, "yyyy-MM-dd"))
    )


def period_header(h: Column) -> Column:
    """struct(end_date, report_type) of a report page's column head; null if it is none.

    A head is a year, perhaps with a quarter (/Q3), and in brackets a month's
    short name and the year's last digits, perhaps after the quarter (K3).
    """
    head = r"(?<year>\d{4})(?<q>/Q\d+)? *\((?<k>K\d)? *(?<month>\p{L}{3}) *\d\d\)"
    year, number, name = F.regexp_extract(h, head, 1), F.regexp_replace(F.concat(F.regexp_extract(h, head, 2), F.regexp_extract(h, head, 3)), r"\D", ""), F.lower(F.regexp_extract(h, head, 4))
    quarterly = number != ""
    month = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in K.MONTHS_PL.items() for x in kv]), name), F.when(quarterly, 3).otherwise(12))
    last = F.last_day(F.make_date(year.try_cast("int"), month, F.lit(1)))
    # yearly figures of companies whose year ends in another month are dated to its 30th
    day = F.when(quarterly | (month == 12), last).otherwise(F.make_date(year.try_cast("int"), month, F.least(F.lit(30), F.dayofmonth(last))))
    known = (year != "") & (~quarterly | (month % 3 == 0))
    return F.when(known, F.struct(F.date_format(day, "yyyy-MM-dd").alias("end_date"), F.when(quarterly, F.concat(F.lit("Q"), number)).otherwise("Annual").alias("report_type")))


def local_number(text: Column) -> Column:
    """A number with blanks between thousands and a decimal comma, perhaps with a scale and a currency after it, in thousands; null for what is none."""
    digits = F.regexp_extract(text, r"(?i)^([-+]?[\d\h]*\d(?:[,.]\d+)?)\h*(?:tys|mln|mld)?\.?\h*(?:PLN|zł)?\h*$", 1)
    return F.translate(F.regexp_replace(digits, r"\h", ""), ",", ".").try_cast("double") * 1000


def link_text(html: Column, href: str) -> Column:
    """Text of the first link whose address begins with ``href``; null without one."""
    return F.nullif(F.trim(F.regexp_extract(html, f'<a[^>]*href="{href}[^"]*"[^>]*>([^<]+)', 1)), F.lit(""))
