"""Rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Round as SQL warehouses round a double: the value times ``10^digits`` to the nearest whole number.

    Spark's own ``round`` takes the decimal text of the double, so it differs where the double lies just
    below the tie its text shows: 1.005 gives 1.0 here and 1.01 there.
    """
    factor = F.lit(float(10 ** digits))
    return F.round(value * factor) / factor
