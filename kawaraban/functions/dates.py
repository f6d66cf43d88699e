"""Dates kept as text in headings, URLs and records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# --- fixed values -----------------------------------------------------------
DAY_HEADING = "のニュース"
DAY_HEADING_SUFFIX = "のニュース一覧"
NEW_ARRIVALS = "新着記事一覧"
STORED_FORMAT = "yyyy年MM月dd日"
FIRST_YEAR, LAST_YEAR = 2010, 2019
# ----------------------------------------------------------------------------


def heading_day(c: Column, year: int, today: dt.date) -> Column:
    """The day a listing heading stands for, or NULL where it names none."""
    month_day = F.replace(c, F.lit(DAY_HEADING_SUFFIX), F.lit(""))
    parsed = F.try_to_date(F.concat(F.lit(f"{year}年"), month_day), "yyyy年M月d日")
    return F.when(c == NEW_ARRIVALS, F.lit(today)).when(c.contains(DAY_HEADING_SUFFIX), parsed)


def heading_date(c: Column, year: int, today: dt.date) -> Column:
    """Heading to stored date text.

    The 'new arrivals' heading stands for ``today``.  A day heading that is no
    date of that year gives NULL; any other heading is kept as it is.
    """
    day = F.date_format(heading_day(c, year, today), STORED_FORMAT)
    is_day = (c == NEW_ARRIVALS) | c.contains(DAY_HEADING_SUFFIX)
    return F.when(is_day, day).otherwise(c)


def stored_day(date_raw: Column) -> Column:
    """The day a stored date text names, with or without a time after it; NULL where it names none."""
    first = F.substring_index(date_raw, " ", 1)
    return F.coalesce(F.try_to_date(first, "yyyy年M月d日"), F.try_to_date(first, "yyyy/M/d"))


def day_key(url: Column) -> Column:
    """Last path segment of a URL, up to its first dot."""
    return F.substring_index(F.substring_index(url, "/", -1), ".", 1)


def year_of(date_raw: Column) -> Column:
    """Leading four characters of a stored date."""
    return F.substring(date_raw, 1, 4)
