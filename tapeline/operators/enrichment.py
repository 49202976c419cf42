"""Quotes lined up with trades, filled, filtered and joined to closes."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeline.functions.joins import join_back
from tapeline.functions.order import packed_order
from tapeline.schemas import COMBINED_COLUMNS, DAY_GROUP_KEY, EVENT_KEY, QUOTE, TRADE

REC_TYPE = "rec_type"
_LATEST = {"trade_pr": "latest_trade_pr", "mov_avg_pr": "mov_avg_pr"}


def combine(
    trades: DataFrame,
    quotes: DataFrame,
    include_bid_pr: bool = False,
    include_rec_type: bool = False,
) -> DataFrame:
    """Set union of trades with their average and quotes.

    Trades keep only key, price and average; the columns one side lacks are
    NULL there.  Equal rows become one.  ``include_rec_type`` adds ``T`` or ``Q``.
    """
    columns = [*COMBINED_COLUMNS, *(["bid_pr"] if include_bid_pr else [])]
    quote_columns = [c for c in columns if c not in ("trade_pr", "mov_avg_pr")]
    if include_rec_type:
        columns.append(REC_TYPE)
    trades = trades.select(*EVENT_KEY, "trade_pr", "mov_avg_pr")
    quotes = quotes.select(*quote_columns)
    return (
        trades.withColumn(REC_TYPE, F.lit(TRADE))
        .unionByName(quotes.withColumn(REC_TYPE, F.lit(QUOTE)), allowMissingColumns=True)
        .select(*columns)
        .distinct()
    )


def filter_quotes(rows: DataFrame) -> DataFrame:
    """Rows that have an ask size (F2)."""
    return rows.where(F.col("ask_size").isNotNull())


def latest_values(
    combined: DataFrame, keys: Sequence[str] = DAY_GROUP_KEY, one_version: bool = False
) -> DataFrame:
    """Trade price and average of each key's last row, be it trade or quote.

    At the same time a quote is later than a trade.  Without a record type, a row
    with an ask size is taken for a quote.  Where there is ``one_version`` of each trade,
    time, kind and sequence number tell the last row (quotes are all alike here), and the
    rows are aggregated by hash, without sorting them first.
    """
    with_type = REC_TYPE in combined.columns
    is_quote = F.col(REC_TYPE) == QUOTE if with_type else F.col("ask_size").isNotNull()
    timed = combined.where(F.col("event_tm").isNotNull())
    if one_version:
        order = packed_order(F.col("event_tm"), is_quote, F.col("event_seq_nb"))
        last = [F.max_by(c, order).alias(name) for c, name in _LATEST.items()]
        return timed.groupBy(*keys).agg(*last)
    order = F.struct(
        "event_tm",
        is_quote,
        *[c for c in combined.columns if c not in (*keys, "event_tm", REC_TYPE)],
    )
    last = timed.groupBy(*keys).agg(F.max_by(F.struct(*_LATEST), order).alias("last"))
    return last.select(*keys, *[F.col(f"last.{c}").alias(name) for c, name in _LATEST.items()])


def fill_latest_eod(
    combined: DataFrame, keys: Sequence[str] = DAY_GROUP_KEY, one_version: bool = False
) -> DataFrame:
    """Every row with the values of its key's last row of the day.

    A key whose last row is a quote gets NULLs.  See ``fill_asof`` for the
    values current at each quote's own time.
    """
    rows = combined.drop("trade_pr", "mov_avg_pr")
    return join_back(rows, latest_values(combined, keys, one_version), keys, how="inner")


def join_close(
    quotes: DataFrame, closes: DataFrame, keys: Sequence[str] = DAY_GROUP_KEY
) -> DataFrame:
    """``quotes`` with ``close_pr``, or NULL where there is none.

    No hint forces the broadcast: ``closes`` grows with days and symbols.  Pass
    a stored or staged table, and the planner broadcasts it when its files are
    within ``spark.sql.autoBroadcastJoinThreshold``; otherwise it is a sort-merge
    join whose hot keys AQE splits.
    """
    return quotes.join(closes.select(*keys, "close_pr"), list(keys), "left")
