"""Person-level scalar functions (full name, completed years, normalisation)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_name(first: Column | str, last: Column | str) -> Column:
    """``first + ' ' + last`` (both columns are NOT NULL in the source)."""
    return F.concat_ws(" ", F.col(first) if isinstance(first, str) else first,
                       F.col(last) if isinstance(last, str) else last)


def completed_years(as_of: dt.date | Column, since: Column | str) -> Column:
    """Whole years between ``since`` and ``as_of``: floor(months_between / 12)."""
    ref = F.lit(as_of) if isinstance(as_of, dt.date) else as_of
    d = F.col(since) if isinstance(since, str) else since
    return F.floor(F.months_between(ref, d) / 12)


def to_int_or_null(c: Column) -> Column:
    """String -> int; anything unparsable becomes NULL instead of failing the job."""
    return c.try_cast("int")


def to_long_or_null(c: Column) -> Column:
    return c.try_cast("bigint")


def to_date_or_null(c: Column, day_first: bool = False) -> Column:
    """``yyyy-MM-dd`` text (or ``dd/MM/yyyy`` with ``day_first``), optionally
    followed by a time after a space or ``T`` (the time is dropped) -> date;
    anything else (or an impossible date such as 02-30) -> NULL."""
    if day_first:
        day = F.regexp_extract(c, r"^(\d{2}/\d{2}/\d{4})([ T].*)?$", 1)
        return F.try_to_date(F.when(day != "", day), "dd/MM/yyyy")
    day = F.regexp_extract(c, r"^(\d{4}-\d{2}-\d{2})([ T].*)?$", 1)
    return F.try_to_date(F.when(day != "", day), "yyyy-MM-dd")


def to_double_or_null(c: Column) -> Column:
    return c.try_cast("double")
