"""Rounded values as decimals, and sums that do not depend on row order.

A rounded ratio that is averaged again is kept as a decimal: decimal sums are exact, so the
result is the same however the rows are partitioned.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def rounded(column: Column, digits: int) -> Column:
    return F.round(column, digits).cast(DecimalType(18, digits))


def mean(column: Column | str) -> Column:
    """The average as a double, divided once at the end. ``avg`` of a decimal rounds to four more
    digits first, which a later rounding then repeats."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def rounded_avg(column: Column | str, digits: int) -> Column:
    """The average of whole numbers or decimals, rounded half up. The division is decimal too, so
    a mean that lies exactly between two results is not decided by a binary fraction."""
    total = F.sum(column).cast(DecimalType(28, 6))
    return rounded(F.try_divide(total, F.count(column)), digits)


def correlation(left: str, right: str) -> Column:
    """Pearson correlation; NULL when one side does not vary (``corr`` raises in ANSI mode)."""
    return F.try_divide(
        F.covar_pop(left, right), F.stddev_pop(left) * F.stddev_pop(right)
    )
