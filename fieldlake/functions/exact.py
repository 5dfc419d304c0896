"""Averages and percentages that do not depend on the order rows arrive in.

Sums of decimals and integers are exact, so partial sums merged in any order
give the same digits, and rounding is half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

COUNT = DecimalType(20, 0)


def mean(
    value: Column | str, places: int = 2, scale: int | None = None, precision: int = 24
) -> Column:
    """Average of `value`, rounded; null when the group has no value.

    Decimals and integers enter as they are. A double's digits depend on the
    order of the sum, unless `scale` names the decimals that each value keeps.
    """
    value = F.col(value) if isinstance(value, str) else value
    exact = value if scale is None else value.cast(DecimalType(precision, scale))
    return F.round(F.try_divide(F.sum(exact), F.count(exact)), places).cast("double")


def rate(hits: Column, places: int = 2, among: Column | None = None) -> Column:
    """Percentage of rows for which `hits` is true.

    The denominator is every row of the group, or the rows for which `among`
    is true.
    """
    total = F.count(F.lit(1)) if among is None else F.count_if(among)
    return share(F.count_if(hits), total, places)


def share(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole for two counts, rounded; null for an empty whole."""
    return F.round(F.try_divide(part.cast(COUNT) * 100, whole.cast(COUNT)), places).cast("double")


def half_away(value: Column, places: int = 2) -> Column:
    """Round a double half away from zero with plain IEEE arithmetic."""
    unit = float(10**places)
    return F.signum(value) * F.floor(F.abs(value) * unit + 0.5) / unit
