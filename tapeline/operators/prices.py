"""Last event times, closing prices and previous closing prices."""

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeline.functions.joins import join_back
from tapeline.functions.order import packed_order
from tapeline.schemas import DAY_GROUP_KEY, GROUP_KEY


def last_event_time(rows: DataFrame, keys: Sequence[str] = GROUP_KEY) -> DataFrame:
    """Time of the last event per key (A2)."""
    return rows.groupBy(*keys).agg(F.max("event_tm").alias("last_event_tm"))


def last_price(
    trades: DataFrame, keys: Sequence[str] = DAY_GROUP_KEY, one_version: bool = False
) -> DataFrame:
    """Price of the last trade per key, as ``close_pr`` (A3).

    At the same time the greater sequence number is the later trade.  Where ``trades``
    hold ``one_version`` of each event, time and sequence number tell the last one, and
    as one number they are aggregated by hash, without sorting the rows first.
    """
    if one_version:
        order = packed_order(F.col("event_tm"), F.lit(False), F.col("event_seq_nb"))
    else:
        order = F.struct("event_tm", "event_seq_nb", "arrival_tm", "trade_pr")
    timed = trades.where(F.col("event_tm").isNotNull())
    return timed.groupBy(*keys).agg(F.max_by("trade_pr", order).alias("close_pr"))


def last_price_literal(trades: DataFrame) -> DataFrame:
    """Closing prices found by the last time alone, per trade date.

    Every trade whose time is some group's last time on that date is returned,
    whatever its own symbol and exchange; ``n_groups`` counts the groups with that
    last time, for each of which a literal join would repeat the row.  Wanted only
    where that literal reading is; see :func:`last_price`.
    """
    times = (
        last_event_time(trades, DAY_GROUP_KEY)
        .where(F.col("last_event_tm").isNotNull())
        .groupBy("trade_dt", F.col("last_event_tm").alias("event_tm"))
        .agg(F.count("*").alias("n_groups"))
    )
    rows = trades.select(*DAY_GROUP_KEY, "event_tm", "trade_pr")
    matched = join_back(rows, times, ["trade_dt", "event_tm"], how="inner")
    return matched.select(*DAY_GROUP_KEY, F.col("trade_pr").alias("close_pr"), "n_groups")


def prev_close(closes: DataFrame, days: DataFrame, calendar_day: bool = False) -> DataFrame:
    """Closing price before each day in ``days``, per symbol and exchange (A4).

    ``closes`` holds ``close_pr`` and ``days`` the wanted rows, both by trade
    date, symbol and exchange.  The close is that of the last earlier trading
    day with one; with ``calendar_day`` it must be of the day before, so Mondays
    have none.  A key's days are few, so one window over them is enough.
    """
    wanted = days.select(*DAY_GROUP_KEY).distinct()
    if calendar_day:
        next_day = closes.select(
            F.date_add("trade_dt", 1).alias("trade_dt"), *GROUP_KEY, "close_pr"
        )
        return wanted.join(next_day, list(DAY_GROUP_KEY), "left")
    earlier = (
        Window.partitionBy(*GROUP_KEY)
        .orderBy("trade_dt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        closes.select(*DAY_GROUP_KEY, "close_pr", F.lit(False).alias("wanted"))
        .unionByName(wanted.withColumn("wanted", F.lit(True)), allowMissingColumns=True)
        .groupBy(*DAY_GROUP_KEY)
        .agg(F.max("close_pr").alias("close_pr"), F.max("wanted").alias("wanted"))
        .withColumn("close_pr", F.last("close_pr", ignorenulls=True).over(earlier))
        .where("wanted")
        .drop("wanted")
    )


def month_of(day: Column) -> Column:
    """The first day of a date's month."""
    return F.trunc(day, "month")


def carried_closes(
    closes: DataFrame, carried: DataFrame, first_month: date | None, last_day: date
) -> DataFrame:
    """The last close of each symbol and exchange at the end of each month (A4).

    ``closes`` are those from ``first_month`` on, ``carried`` those last known at the
    end of the month before it, if any, both by trade date, symbol and exchange.
    A row keeps the trade date it is of; ``month`` runs on to that of ``last_day``, also for
    keys that are not traded any more.  A close that is NULL is none.  Closes are reduced to
    one per key and month before they are shuffled, and a key then has a row a month.
    """
    columns = [*DAY_GROUP_KEY, "close_pr"]
    before = F.lit(None).cast("date") if first_month is None else F.add_months(F.lit(first_month), -1)
    monthly = (
        closes.select(*columns)
        .unionByName(carried.select(*columns))
        .where(F.col("close_pr").isNotNull())
        .groupBy(*GROUP_KEY, F.greatest(month_of(F.col("trade_dt")), before).alias("month"))
        .agg(F.max_by("close_pr", "trade_dt").alias("close_pr"), F.max("trade_dt").alias("trade_dt"))
    )
    following = F.lead("month").over(Window.partitionBy(*GROUP_KEY).orderBy("month"))
    until = F.coalesce(F.add_months(following, -1), month_of(F.lit(last_day)).cast("date"))
    months = F.sequence("month", F.greatest("month", "until"), F.expr("INTERVAL '1' MONTH"))
    return monthly.withColumn("until", until).select(F.explode(months).alias("month"), *columns)
