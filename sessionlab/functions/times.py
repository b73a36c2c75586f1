"""Time expressions."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from sessionlab.functions.numbers import rounded

# Names for dayofweek 1..7.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
WEEKEND_DAYS = (1, 7)
WEEKEND, WEEKDAY = "Weekend", "Weekday"


def parse_event_time(name: str) -> Column:
    """ISO-8601 text to a timestamp; text that does not parse becomes NULL instead of an error."""
    return F.try_to_timestamp(F.col(name))


def seconds(column: Column | str) -> Column:
    """Whole epoch seconds."""
    return F.unix_timestamp(column)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return seconds(end) - seconds(start)


def minutes_between(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    return rounded(seconds_between(start, end) / F.lit(Decimal("60.0")), digits)


def hours_between(start: Column | str, end: Column | str, digits: int = 2) -> Column:
    return rounded(seconds_between(start, end) / F.lit(Decimal("3600.0")), digits)


def day_name(day_of_week: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), day_of_week)


def period_type(day_of_week: Column) -> Column:
    return F.when(day_of_week.isin(*WEEKEND_DAYS), WEEKEND).otherwise(WEEKDAY)
