"""Scalar text helpers: clock strings, name cleaning, tokens, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock_to_seconds(c: Column) -> Column:
    """``"m:ss"`` to seconds: minutes before the colon times 60 plus the seconds after it (NULL if malformed)."""
    minutes = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("bigint")
    seconds = F.split_part(c, F.lit(":"), F.lit(-1)).try_cast("bigint")
    return minutes * 60 + seconds


def clean_name(c: Column) -> Column:
    """Lower-case a name and turn every run of non-alphanumeric characters into one ``_``."""
    return F.lower(F.regexp_replace(F.regexp_replace(c, r"[^\p{Alnum}]+", " "), " ", "_"))


def last_token(c: Column, sep: str = " ") -> Column:
    """Last whitespace-separated token (``"City CODE"`` -> ``"CODE"``)."""
    return F.element_at(F.split(c, sep), -1)


def age_years(birth: Column, as_of: Column) -> Column:
    """Age in years between month starts, rounded to 2 places; the as-of date is a parameter, not the clock."""
    return F.round(F.months_between(F.trunc(as_of, "month"), F.trunc(birth, "month")) / 12, 2)


def parse_month_day_year(c: Column) -> Column:
    """``"September/9/2021"``-style text to a date."""
    return F.try_to_date(c, "MMMM/d/yyyy")
