"""Time-of-day arithmetic on seconds since midnight."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def wrap_duration(start_s: Column, end_s: Column) -> Column:
    """Seconds from start to end, over midnight when the end is earlier.

    An end at 24:00 is the end of the day, so 00:00 to 24:00 is a whole day.
    """
    seconds = end_s - start_s
    return F.when(seconds < 0, seconds + DAY_SECONDS).otherwise(seconds).cast("int")
