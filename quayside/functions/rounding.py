"""Rounding of doubles.

``pyspark.sql.functions.round`` works on the decimal text of a double, which
differs from SQL engines and numpy that scale, round to an integer and scale
back (1.005 is the usual example). Both integer rules are offered here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def half_even(value: Column | str, digits: int) -> Column:
    """numpy's rule, for columns that were rounded in a data frame."""
    scale = float(10**digits)
    return F.rint(_column(value).cast("double") * scale) / F.lit(scale)


def half_away(value: Column | str, digits: int) -> Column:
    """The SQL rule, for columns that were rounded in a query."""
    scale = float(10**digits)
    return F.round(_column(value).cast("double") * scale) / F.lit(scale)
