"""Column expressions: all built-in, JVM-side, codegen-friendly."""

from .casting import float_or_zero, keep_string, pad_hhmm, to_int
from .expressions import (
    iso_date,
    mean2,
    plus_days,
    route,
)

__all__ = [
    "float_or_zero",
    "iso_date",
    "keep_string",
    "mean2",
    "pad_hhmm",
    "plus_days",
    "route",
    "to_int",
]
