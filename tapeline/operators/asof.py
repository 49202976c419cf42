"""Trade values as of each quote."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.cells import DAY_SECONDS, cell_start, epoch_second
from tapeline.functions.joins import join_back
from tapeline.operators.moving_average import tick_averages
from tapeline.schemas import DAY_GROUP_KEY, DAY_SYMBOL_KEY

# Time is cut into seconds.  Without the trade date among the keys, the seconds
# are cut into days as well; with it, they are at most a day's.
_CELLS_OF_A_DAY = (1,)
_CELLS = (1, DAY_SECONDS)


def _last_known(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    position: Column,
    values: Sequence[str],
    widths: Sequence[int],
    upto: int,
    of_key: DataFrame | None = None,
) -> DataFrame:
    """Replace ``values`` by their last non-NULL along ``order``, which is unique.

    ``of_key`` has one row per ``keys``; its other columns are added.  They enter with
    the rows carried into each cell, so they are joined to these few rows alone.

    ``upto`` 0 includes the row itself, -1 does not.  The last values of every
    cell are carried forward over the cells first, in the same way with the
    next width, and then enter each cell as a row before its own rows.  So a
    window only ever holds one cell's rows.
    """

    def last_in(window):
        return {v: F.last(v, ignorenulls=True).over(window) for v in values}

    ordered = Window.partitionBy(*keys).orderBy(order)
    if not widths:
        return rows.withColumns(last_in(ordered.rowsBetween(Window.unboundedPreceding, upto)))
    width, *wider = widths
    cell = f"__cell_{width}"
    celled = rows.withColumn(cell, cell_start(position, width))
    cells = celled.groupBy(*keys, cell).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values]
    )
    carried = _last_known(cells, keys, cell, F.col(cell), values, wider, upto=-1)
    if of_key is not None:
        carried = carried.join(of_key, list(keys), "left")
        values = [*values, *[c for c in of_key.columns if c not in keys]]
    # the carried row has no place in the order and so sorts before all others
    entries = celled.withColumn("__carried", F.lit(False)).unionByName(
        carried.withColumn("__carried", F.lit(True)), allowMissingColumns=True
    )
    within = (
        Window.partitionBy(*keys, cell)
        .orderBy(F.asc_nulls_first(order))
        .rowsBetween(Window.unboundedPreceding, upto)
    )
    known = entries.withColumns(last_in(within)).where(~F.col("__carried"))
    return known.drop(cell, "__carried")


def last_at_time(
    trades: DataFrame, keys: Sequence[str], values: Sequence[str], time: str = "event_tm"
) -> DataFrame:
    """Last non-NULL ``values`` by sequence number per key and time."""
    return trades.groupBy(*keys, time).agg(
        *[
            F.max_by(v, F.when(F.col(v).isNotNull(), F.col("event_seq_nb"))).alias(v)
            for v in values
        ]
    )


def trade_points(
    trades: DataFrame,
    length_seconds: int = 1800,
    average_keys: Sequence[str] = DAY_SYMBOL_KEY,
    keys: Sequence[str] = DAY_GROUP_KEY,
) -> DataFrame:
    """``trade_pr`` and ``mov_avg_pr`` per key and time, ready for :func:`fill_asof`.

    ``trades`` holds one version of each event, see ``keep_latest``.  ``average_keys``
    are among ``keys``.  The average depends on nothing but its keys and the time, so
    these few rows read it, not the trades.
    """
    points = last_at_time(trades, keys, ["trade_pr"])
    averaged = tick_averages(trades, length_seconds, average_keys, readers=points)
    return averaged.select(*keys, "event_tm", "trade_pr", "mov_avg_pr")


def fill_asof(
    quotes: DataFrame,
    points: DataFrame,
    keys: Sequence[str] = DAY_GROUP_KEY,
    values: Sequence[str] = ("trade_pr", "mov_avg_pr"),
    time: str = "event_tm",
    of_key: DataFrame | None = None,
) -> DataFrame:
    """``quotes`` with the ``values`` of the last point at or before their time.

    ``points`` has one row per key and time.  At the same time the trade comes
    before the quote.  Each value is filled on its own, past points where it is
    NULL, and is NULL before the first one.  ``of_key`` has one row per key, whose
    other columns are added on the way, so that the quotes move once for both; a
    quote without a key or time gets NULLs.
    """
    times = (
        points.select(*keys, time, *values)
        .unionByName(quotes.select(*keys, time), allowMissingColumns=True)
        .where(F.col(time).isNotNull())
        .groupBy(*keys, time)
        .agg(*[F.max(v).alias(v) for v in values])
    )
    position = epoch_second(F.col(time).cast("timestamp_ntz"))
    widths = _CELLS_OF_A_DAY if "trade_dt" in keys else _CELLS
    filled = _last_known(times, keys, time, position, values, widths, 0, of_key)
    return join_back(quotes, filled, [*keys, time])
