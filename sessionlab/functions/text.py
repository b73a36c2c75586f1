"""String clean-up with JVM expressions only."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitize(name: str) -> Column:
    """Drop control characters, then trim; NULL stays NULL."""
    return F.trim(F.regexp_replace(F.col(name), r"\p{Cntrl}", ""))
