"""Trailing moving average over a length of time.

Each tick's frame is ``[t - length, t]``, both ends included, so ticks of the
same time all count for one another.  A range window per symbol would add up
the whole frame again for every tick and keep a symbol's history in one task.
Here time is cut into cells (a second by default) and a frame is put together
from exact sums:

* ticks of one key and time are summed first, with partial aggregation;
* over cells, a running sum gives the total of the cells before each cell that
  lie within the length;
* within a cell, a running sum adds each tick when it comes and takes it away
  when it has left the frame, ``length`` later.

So every sum is a running one, of linear cost, and a task's group is at most
the distinct times of one cell, or three times the cells of one length.  Sums
are DECIMAL, so adding and taking away leaves no rounding error.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.cells import cell_start, epoch_second
from tapeline.functions.joins import join_back
from tapeline.schemas import PRICE, PRICE_SUM

# order of entries at the same position: first what is carried in, then the
# ticks, then who reads the frame, then what leaves it after them
_CARRIED, _OWN, _READING, _LEAVING = -1, 0, 1, 2


def _entry(cell: Column, position: Column, kind: int, sign: int) -> Column:
    return F.struct(
        cell.alias("cell"),
        position.alias("position"),
        F.lit(kind).alias("kind"),
        (F.col("total") * sign).cast(PRICE_SUM).alias("total"),
        (F.col("n") * sign).alias("n"),
    )


def _running(keys: Sequence[str]):
    return (
        Window.partitionBy(*keys, "cell")
        .orderBy("position", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _carried_in(ticks: DataFrame, keys: Sequence[str], length: int, width: int) -> DataFrame:
    """For each cell, the sum over the cells in ``[cell - length, cell)``.

    Ticks without a time are left out at the end: leaving them out at the start
    would make this a second computation of ``ticks`` in place of a second
    reader of the same shuffle.
    """
    cells = ticks.groupBy(*keys, F.col("cell").alias("start")).agg(
        F.sum("total").cast(PRICE_SUM).alias("total"), F.sum("n").alias("n")
    )
    start, nowhere = F.col("start"), F.lit(None).cast("bigint")
    block = cell_start(start, length)
    # A cell counts in its own block from its place on, and in the next block
    # from the beginning until the length has passed.
    entries = cells.select(
        *keys,
        F.inline(
            F.array(
                _entry(block, start, _OWN, 1),
                _entry(block + length, nowhere, _CARRIED, 1),
                _entry(block + length, start + length, _LEAVING, -1),
            )
        ),
    )
    running = _running(keys)
    return (
        entries.withColumns(
            {
                "total_to": F.sum("total").over(running) - F.col("total"),
                "n_to": F.sum("n").over(running) - F.col("n"),
            }
        )
        .where((F.col("kind") == _OWN) & (F.col("n_to") > 0) & F.col("position").isNotNull())
        .select(
            *keys,
            F.col("position").alias("cell"),
            F.col("total_to").cast(PRICE_SUM).alias("total"),
            F.col("n_to").alias("n"),
        )
    )


def tick_averages(
    trades: DataFrame,
    length_seconds: int = 1800,
    keys: Sequence[str] = ("symbol",),
    time: str = "event_tm",
    price: str = "trade_pr",
    cell_seconds: int = 1,
    readers: DataFrame | None = None,
) -> DataFrame:
    """``mov_avg_pr`` for each distinct key and time of ``trades``.

    Ticks without a time are averaged among themselves.  ``readers`` has rows with
    the keys and a time, few for each; with it, these rows come back with the average
    at their time, from the same window and so without a join.
    """
    if length_seconds <= 0 or cell_seconds <= 0 or length_seconds % cell_seconds:
        raise ValueError("the length must be a positive multiple of the cell")
    position = F.col("position")
    ticks = (
        trades.groupBy(*keys, F.col(time).cast("timestamp_ntz").alias("position"))
        .agg(
            F.coalesce(F.sum(F.col(price).cast(PRICE)), F.lit(0)).cast(PRICE_SUM).alias("total"),
            F.count(price).alias("n"),
        )
        .withColumn("cell", cell_start(epoch_second(position), cell_seconds))
    )
    cell = F.col("cell")
    own = _entry(cell, position, _OWN, 1)
    leaving = _entry(
        cell + length_seconds,
        position + F.expr(f"INTERVAL '{length_seconds}' SECOND"),
        _LEAVING,
        -1,
    )
    carried = _carried_in(ticks, keys, length_seconds, cell_seconds).select(
        *keys, F.inline(F.array(_entry(cell, F.lit(None).cast("timestamp_ntz"), _CARRIED, 1)))
    )
    entries = ticks.select(
        *keys, F.inline(F.when(cell.isNull(), F.array(own)).otherwise(F.array(own, leaving)))
    ).unionByName(carried)
    shown, extra = _OWN, []
    if readers is not None:
        shown, extra = _READING, [c for c in readers.columns if c not in (*keys, time)]
        read_at = F.col(time).cast("timestamp_ntz")
        reading = readers.select(
            *keys,
            *extra,
            cell_start(epoch_second(read_at), cell_seconds).alias("cell"),
            read_at.alias("position"),
            F.lit(_READING).alias("kind"),
            F.lit(0).cast(PRICE_SUM).alias("total"),
            F.lit(0).cast("bigint").alias("n"),
        )
        entries = entries.unionByName(reading, allowMissingColumns=True)
    frame = _running(keys)
    return (
        entries.withColumns(
            {"frame_total": F.sum("total").over(frame), "frame_n": F.sum("n").over(frame)}
        )
        .where(F.col("kind") == shown)
        .select(
            *keys,
            position.alias(time),
            *extra,
            F.when(
                F.col("frame_n") > 0, F.col("frame_total").cast("double") / F.col("frame_n")
            ).alias("mov_avg_pr"),
        )
    )


def moving_average(
    trades: DataFrame,
    length_seconds: int = 1800,
    keys: Sequence[str] = ("symbol",),
    time: str = "event_tm",
    price: str = "trade_pr",
    cell_seconds: int = 1,
) -> DataFrame:
    """``trades`` with ``mov_avg_pr``, the average over the trailing length.

    By default one average runs over all exchanges of a symbol; name the
    exchange in ``keys`` for one per exchange.  Prices count as DECIMAL(18,4).
    """
    averages = tick_averages(trades, length_seconds, keys, time, price, cell_seconds)
    return join_back(trades, averages, [*keys, time], null_safe=True)
