"""Text to typed columns, without ANSI errors on bad text."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# the usual form: a local time after its date; matched far sooner than the next, which it never matches
_PLAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:\.\d+)?$"
_ZONED = r"\d{1,2}:\d{2}.*?(?:[A-Za-z]|[+-]\d{1,2}(?::?\d{2})?)\s*$"


def whole_number(text: Column) -> Column:
    """BIGINT of text such as ``100``, ``100.0`` or ``1.0E7``; NULL for ``100.5``."""
    number = text.try_cast("decimal(38,6)")
    return F.coalesce(
        text.try_cast("bigint"), F.when(number == F.floor(number), number.try_cast("bigint"))
    )


def event_time(text: Column, date_text: Column, zone: str | None = None) -> Column:
    """TIMESTAMP_NTZ of a date-time text.

    A text with a time only belongs to ``date_text``: a plain cast would put it on the day
    the job happens to run.  Times are local and have no zone; a plain cast would also pass
    over an offset or a zone after the time.  Such a text casts only if the time zone
    is named that times are local to: it is the instant it tells, shown there.  So of the
    hour that is repeated when clocks go back both instants have the same local time, and
    none falls into the hour left out when they go forward.  A text without zone stays
    as it is written, in such hours too.
    """
    zoned = text.rlike(_ZONED)
    full = F.when(text.rlike(r"^\s*\d{1,2}:\d{2}"), F.concat_ws(" ", date_text, F.trim(text)))
    full = full.otherwise(text)
    local = F.when(~zoned, full.try_cast("timestamp_ntz"))
    other = local if zone is None else F.coalesce(local, F.when(zoned, _shown_in(full, zone)))
    return F.when(text.rlike(_PLAIN), text.try_cast("timestamp_ntz")).otherwise(other)


def _shown_in(text: Column, zone: str) -> Column:
    """Local time in ``zone`` of a text with a zone of its own, in any session time zone."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(text.try_cast("timestamp")), start)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def typed(name: str, type_name: str, zone: str | None = None) -> Column:
    """Column ``name`` of the all-text event table as ``type_name``; see :func:`event_time`."""
    text = F.col(name)
    if type_name == "timestamp_ntz":
        return event_time(text, F.col("trade_dt"), zone)
    if type_name == "bigint":
        return whole_number(text)
    value = text.try_cast(type_name)
    if type_name.startswith("decimal"):  # a number that the type would round does not cast
        return F.when(value == text.try_cast("decimal(38,20)"), value)
    return value
