"""Text-to-value conversions that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_int(c: str | Column) -> Column:
    """Integer from raw text such as ``'-14.00'``: via double, truncated; NULL if not numeric."""
    return _col(c).try_cast("double").try_cast("int")


def float_or_zero(c: str | Column) -> Column:
    """Delay as the streams count it: a number, or 0 for anything that is not one."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def keep_string(c: str | Column) -> Column:
    """String column of the typed table: an empty field stays ``''``, never NULL."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def pad_hhmm(c: str | Column) -> Column:
    """Left-pad an all-digit clock time to 4 characters (``'5'`` -> ``'0005'``)."""
    c = _col(c)
    return F.when(c.rlike("^[0-9]{1,3}$"), F.lpad(c, 4, "0")).otherwise(c)
