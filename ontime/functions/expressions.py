"""Small expression builders used across the named jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .casting import _col


def mean2(c: str | Column) -> Column:
    """``round(avg(x), 2)``: NULLs skipped, half-up, NULL when the group has no value."""
    return F.round(F.avg(_col(c)), 2)


def route(*parts: str | Column) -> Column:
    """``a-b[-c]``; NULL when any part is NULL (``concat``, not ``concat_ws``)."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(_col(p))
    return F.concat(*pieces)


def iso_date(c: str | Column) -> Column:
    """A ``yyyy-MM-dd`` text date as DATE; NULL (never an error) for a bad value."""
    return F.try_to_date(_col(c), "yyyy-MM-dd")


def plus_days(c: str | Column, days: int) -> Column:
    """``date_add`` on a text date; NULL for a bad date, so it never matches anything."""
    return F.date_add(iso_date(c), days)
