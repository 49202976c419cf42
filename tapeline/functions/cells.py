"""Time cells: fixed, epoch-aligned stretches of time numbered by their start.

Operators that run along time split a key into cells so that no task ever
holds more than the distinct time stamps of one cell, however hot the key is.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def epoch_second(stamp: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ, in any session time zone."""
    days = F.unix_date(stamp.cast("date")).cast("bigint")
    return days * DAY_SECONDS + F.hour(stamp) * 3600 + F.minute(stamp) * 60 + F.second(stamp)


def cell_start(position: Column, width: int) -> Column:
    """Start of the cell of ``width`` that holds ``position``; exact before 1970 too."""
    return position - F.pmod(position, F.lit(width).cast("bigint"))
