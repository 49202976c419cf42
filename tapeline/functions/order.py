"""Several ordering columns as one number, which a hash aggregate can hold."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = "decimal(38,0)"
#: micros since 1970 of a time stamp lie within this of zero, up to the year 9999
_MICROS = 1 << 58
_LONGS = 1 << 64


def micros(stamp: Column) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ, in any session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), stamp)


def packed_order(stamp: Column, flag: Column, number: Column) -> Column:
    """A DECIMAL(38,0) that orders as (time, flag, whole number) does.

    Mixed radix: each part is shifted to be at least zero and has a range of its own, so
    the greatest value is below 2**59 * 2 * 2**64, within 38 digits. A struct of the three would
    order the same, but no hash aggregate keeps one, so rows would be sorted first.
    """
    shifted = (micros(stamp) + F.lit(_MICROS)).cast(_NUMBER) * F.lit(2).cast("decimal(1,0)")
    major = (shifted + flag.cast("int").cast("decimal(1,0)")).cast("decimal(19,0)")
    minor = number.cast("decimal(20,0)") + F.lit(str(1 << 63)).cast("decimal(20,0)")
    return (major * F.lit(str(_LONGS)).cast("decimal(20,0)") + minor).cast(_NUMBER)
