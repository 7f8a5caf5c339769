"""Numeric helpers shared by every money / distance / pace column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Round to ``scale`` decimals, half up, as a double.

    Goes through ``decimal(20,6)`` first so the result does not depend on the
    binary noise of the double (``745.5360000000001`` rounds like ``745.536``).
    """
    return F.round(c.cast("decimal(20,6)"), scale).cast("double")


def metres_to_km_2dp(metres: Column) -> Column:
    """Whole metres -> km with 2 decimals, rounding the binary quotient as printf does.

    The pay threshold is compared with this value: 25,005 m is 25.0 km (the
    quotient lies just below the tie), 15,015 m is 15.02 or 15.01 as its
    quotient says. A decimal half-up rounding differs for one metre value in
    twenty.
    """
    return F.call_function("format_number", metres / F.lit(1000.0), F.lit("0.00")).cast("double")
