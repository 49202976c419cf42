"""Typed trade and quote tables, and the latest version of each event."""

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.casts import typed
from tapeline.functions.joins import join_back
from tapeline.schemas import EVENT_KEY, QUOTE_TYPES, TRADE_TYPES


def _with_typed(events: DataFrame, types: dict[str, str], zone: str | None) -> DataFrame:
    """``events`` with the typed columns of ``types`` under :func:`_typed_name`.

    They leave as the single element of an inlined array.  Catalyst would copy the casts into
    each filter and each select on a typed column, to the scan; it does not move them
    below a generator, so each text is cast once.
    """
    row = F.struct(*[typed(c, t, zone).alias(_typed_name(c)) for c, t in types.items()])
    return events.select("*", F.inline(F.array(row)))


def _typed_name(name: str) -> str:
    return f"__typed_{name}"


def _failed_cast(types: dict[str, str]) -> Column:
    """True where a text that is present does not cast to its type, or a key is NULL."""
    return reduce(
        or_,
        [
            F.col(_typed_name(c)).isNull() & (F.lit(c in EVENT_KEY) | F.col(c).isNotNull())
            for c in types
        ],
    )


def typed_rows(events: DataFrame, types: dict[str, str], zone: str | None = None) -> DataFrame:
    """Rows of the all-text event table whose texts all cast, as ``types``.

    Times are local to ``zone``; without it, a time with an offset or a zone does not cast.
    """
    rows = _with_typed(events, types, zone).where(~_failed_cast(types))
    return rows.select(*[F.col(_typed_name(c)).alias(c) for c in types])


def rejected_rows(
    events: DataFrame, types: dict[str, str], *extra: str, zone: str | None = None
) -> DataFrame:
    """The rows :func:`typed_rows` leaves out, still as text, after ``extra`` columns."""
    return _with_typed(events, types, zone).where(_failed_cast(types)).select(*extra, *types)


def trade_rows(events: DataFrame, zone: str | None = None) -> DataFrame:
    """Typed trades out of the T partition."""
    return typed_rows(events, TRADE_TYPES, zone)


def quote_rows(events: DataFrame, zone: str | None = None) -> DataFrame:
    """Typed quotes out of the Q partition."""
    return typed_rows(events, QUOTE_TYPES, zone)


def latest_arrival(
    rows: DataFrame, keys: Sequence[str] = EVENT_KEY, arrival: str = "arrival_tm"
) -> DataFrame:
    """Greatest arrival time and number of versions of each event (A1)."""
    return rows.groupBy(*keys).agg(
        F.max(arrival).alias("latest"), F.count("*").alias("n_versions")
    )


def annotate_latest(
    rows: DataFrame, keys: Sequence[str] = EVENT_KEY, arrival: str = "arrival_tm"
) -> DataFrame:
    """Every version of every event, with its event's ``latest`` arrival.

    Nothing is dropped but rows with a NULL in the key.  A window over the key
    would put all versions of one event into one task; the aggregate combines
    them before the shuffle, and the join back can be split.  Most events have one
    version, which is its own latest: only corrected ones take part in the join.
    """
    keyed = rows.dropna(subset=list(keys))
    rest = [c for c in rows.columns if c not in (*keys, "latest")]
    events = latest_arrival(keyed, keys, arrival)
    corrected = events.where("n_versions > 1").drop("n_versions")
    joined = join_back(keyed.select(*keys, *rest), corrected, keys)
    return joined.select(*keys, *rest, F.coalesce("latest", arrival).alias("latest"))


def keep_latest(
    rows: DataFrame, keys: Sequence[str] = EVENT_KEY, arrival: str = "arrival_tm"
) -> DataFrame:
    """One row per event: the version that arrived last (A5).

    Versions with the same arrival time are told apart by their other columns,
    so a rerun keeps the same one.  Rows with a NULL in the key are dropped.
    Spark keeps only the first row of each key per task before the shuffle, so
    an event with very many versions stays small.  The key's last column comes first in
    the sort, as it tells most events apart: the earlier ones are alike for very many rows.
    """
    versions = rows.drop("latest")
    others = [c for c in versions.columns if c not in keys and c != arrival]
    newest_first = [F.desc_nulls_last(arrival), *[F.desc_nulls_last(c) for c in others]]
    rank = F.row_number().over(Window.partitionBy(*reversed(keys)).orderBy(*newest_first))
    return (
        versions.dropna(subset=list(keys))
        .withColumn("__rank", rank)
        .where(F.col("__rank") == 1)
        .select(*keys, arrival, *others, F.col(arrival).alias("latest"))
    )
