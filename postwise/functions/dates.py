"""Date functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from postwise import rules as R
from postwise.functions.text import _col, strip_ws


def _shape(fmt: str) -> str:
    """A regex every string parseable by ``fmt`` matches (digit runs of the
    pattern's letters, separators kept). It lets a format be skipped without
    a parse attempt, whose failure costs an exception per row."""
    import re

    def run(m):
        letters = m.group(0)
        n = len(letters)
        return r"\d{1,%d}" % max(n, 2) if letters[0] != "y" else r"\d{%d}" % n

    body = re.sub(r"([A-Za-z])\1*", run, fmt.replace(".", r"\."))
    return "^" + body + "$"


def parse_date(c, formats: list[str] | None = None) -> Column:
    """First format that parses the whole text wins, else NULL."""
    c = _col(c)
    fmts = formats or R.DATE_FORMATS
    tries = [F.when(c.rlike(_shape(f)), F.try_to_timestamp(c, F.lit(f))) for f in fmts]
    return F.coalesce(*tries).cast("date")


def parse_date_or(c, run_date: str | _dt.date, formats: list[str] | None = None) -> Column:
    """struct(posting_date, date_defaulted): unparseable or missing dates
    become ``run_date`` (a parameter, not the wall clock) and are flagged."""
    text = strip_ws(_col(c))
    # An ISO date with a time of day is read by its date.
    timed = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?Z?$"),
                   parse_date(F.substring(text, 1, 10), ["yyyy-MM-dd"]))
    parsed = F.coalesce(parse_date(text, formats or R.BASIC_DATE_FORMATS), timed)
    run = F.lit(str(run_date)).cast("date")
    return F.struct(F.coalesce(parsed, run).alias("posting_date"), parsed.isNull().alias("date_defaulted"))


def week_mode1(d) -> Column:
    """P20: MySQL ``WEEK(d, 1)``: Monday-start weeks numbered 0..53.

    ISO week, except January days still in the previous ISO year are week 0
    and late-December days in the next ISO year are week 53.
    """
    d = _col(d)
    w = F.weekofyear(d)
    return (F.when((F.month(d) == 1) & (w >= 52), F.lit(0))
            .when((F.month(d) == 12) & (w == 1), F.lit(53))
            .otherwise(w))


TIME_ATTRIBUTE_NAMES = ["posting_day", "posting_month", "posting_quarter", "posting_year", "posting_weekday",
                        "is_weekend", "time_key", "day", "month", "month_name", "quarter", "year",
                        "week_of_year", "day_of_week", "day_name"]


def time_attributes(d) -> list[Column]:
    """The time-dimension attributes of a date, in both name sets."""
    d = _col(d)
    return [
        F.dayofmonth(d).alias("posting_day"),
        F.month(d).alias("posting_month"),
        F.quarter(d).alias("posting_quarter"),
        F.year(d).alias("posting_year"),
        F.date_format(d, "EEEE").alias("posting_weekday"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        d.alias("time_key"),
        F.dayofmonth(d).alias("day"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]
