"""Date and time reading as Column expressions; unreadable text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nulls import as_col

ISO_TIME = "yyyy-MM-dd HH:mm:ss"
US_TIME = "M/d/yyyy H:mm"
US_DATE = "M/d/yyyy"


def parse_time(c: Column | str, pattern: str) -> Column:
    """Zone-less time in the given pattern."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("timestamp_ntz")


def parse_date(c: Column | str, pattern: str = US_DATE) -> Column:
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("date")


def rate_per(amount: Column | str, time: Column | str, unit: float = 600.0) -> Column:
    """Amount per ``unit`` of time; NULL when no time was played."""
    return F.try_divide(as_col(amount) * F.lit(unit), as_col(time))
