import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tables import at, trades, values
from tapeline.operators.moving_average import moving_average

FIXTURE = [
    ("A", "N", "09:00:00.0", 1, "10"),
    ("A", "Q", "09:30:00.0", 2, "20"),
    ("A", "N", "09:30:00.1", 3, "30"),
    ("A", "N", "09:40:00.0", 4, "31"),
    ("B", "N", "09:30:00.1", 1, "99"),
    ("B", "N", "09:40:00.0", 2, "98"),
    ("B", "N", None, 5, "97"),
]


@pytest.mark.parametrize("cell", [1, 60, 600, 1800])
def test_frame_bounds_exchanges_and_missing_times(spark, cell):
    found = moving_average(trades(spark, FIXTURE), cell_seconds=cell)
    assert values(found, "symbol", "event_seq_nb", "mov_avg_pr") == [
        ("A", 1, 10.0), ("A", 2, 15.0), ("A", 3, 25.0), ("A", 4, 27.0),
        ("B", 1, 99.0), ("B", 2, 98.5), ("B", 5, 97.0),
    ]


def test_keys_are_a_parameter(spark):
    found = moving_average(trades(spark, FIXTURE), keys=("symbol", "exchange"))
    assert ("A", 2, 20.0) in values(found, "symbol", "event_seq_nb", "mov_avg_pr")


def test_ticks_of_the_same_time_all_count(spark):
    rows = [("A", "N", "09:00:00", 1, "1"), ("A", "N", "09:00:00", 2, "2")]
    assert values(moving_average(trades(spark, rows)), "mov_avg_pr") == [(1.5,), (1.5,)]


def test_missing_prices_do_not_count(spark):
    rows = [
        ("A", "N", "09:00:00", 1, None),
        ("A", "N", "09:01:00", 2, "4"),
        ("A", "N", "09:02:00", 3, None),
    ]
    assert values(moving_average(trades(spark, rows)), "event_seq_nb", "mov_avg_pr") == [
        (1, None), (2, 4.0), (3, 4.0),
    ]


def test_missing_symbols_form_a_key(spark):
    rows = [(None, "N", "09:00:00", 1, "1"), (None, "N", "09:01:00", 2, "3")]
    assert values(moving_average(trades(spark, rows)), "event_seq_nb", "mov_avg_pr") == [
        (1, 1.0), (2, 2.0),
    ]


def test_cell_must_divide_the_length(spark):
    with pytest.raises(ValueError):
        moving_average(trades(spark, FIXTURE), 100, cell_seconds=60)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_session_zone_does_not_matter(spark, settings, zone):
    """On this day New York has no time between two and three o'clock."""
    settings({"spark.sql.session.timeZone": zone})
    times = ["01:45:00", "02:10:00", "02:20:00", "03:05:00"]
    rows = [("A", "N", t, i, str(i), t, "2020-03-08") for i, t in enumerate(times)]
    found = moving_average(trades(spark, rows))
    assert values(found, "event_seq_nb", "mov_avg_pr") == [(0, 0.0), (1, 0.5), (2, 1.5), (3, 3.0)]


def brute_force(ticks, length):
    """Average of [t - length, t] for each (symbol, time, seq, price)."""
    found = []
    for symbol, time, seq, _ in ticks:
        frame = [
            p for s, t, _, p in ticks if s == symbol and time - timedelta(seconds=length) <= t <= time
        ]
        found.append((symbol, seq, sum(frame) / len(frame)))
    return sorted(found, key=repr)


@pytest.mark.parametrize("length,cell,spread", [(10, 1, 40), (10, 5, 300), (60, 60, 200), (3, 1, 8)])
def test_against_brute_force(spark, length, cell, spread):
    chance = random.Random(length * spread)
    start = datetime(1969, 12, 31, 23, 59, 50)
    ticks = [
        (
            chance.choice("AAAB"),
            # half of the times fall on whole seconds, so frames end on ticks
            start
            + timedelta(
                seconds=chance.randrange(spread),
                microseconds=chance.choice([0, 0, 1, 250_000, 999_999]),
            ),
            seq,
            float(chance.randrange(1, 1000)),
        )
        for seq in range(400)
    ]
    rows = spark.createDataFrame(
        ticks, "symbol string, event_tm timestamp_ntz, event_seq_nb bigint, trade_pr double"
    ).withColumn("trade_pr", F.col("trade_pr").cast("decimal(18,4)"))
    found = moving_average(rows, length, cell_seconds=cell)
    assert values(found, "symbol", "event_seq_nb", "mov_avg_pr") == brute_force(ticks, length)


def test_hot_symbol_and_hot_time(spark):
    """A third of all rows at one time of one symbol, another third in one minute."""
    n = 60_000
    base = F.lit(at("10:00:00")).cast("timestamp_ntz")
    kind = F.col("id") % 3
    offset = (
        F.when(kind == 0, 0).when(kind == 1, (F.col("id") * 997) % 60_000_000)
        .otherwise(F.col("id") * 1_000_000)
    )
    rows = spark.range(n).select(
        F.when(kind == 2, F.concat(F.lit("S"), F.col("id") % 50)).otherwise("HOT").alias("symbol"),
        (base + F.make_dt_interval(secs=(offset / 1_000_000).cast("decimal(18,6)"))).alias(
            "event_tm"
        ),
        F.col("id").alias("event_seq_nb"),
        (F.col("id") % 100).cast("decimal(18,4)").alias("trade_pr"),
    )
    found = moving_average(rows)
    assert found.count() == n
    rows.createOrReplaceTempView("hot_ticks")
    plain = spark.sql(
        """SELECT symbol, event_seq_nb, CAST(sum(trade_pr) OVER w AS DOUBLE) / count(trade_pr) OVER w
             AS expected FROM hot_ticks WHERE symbol <> 'HOT'
           WINDOW w AS (PARTITION BY symbol ORDER BY event_tm
             RANGE BETWEEN INTERVAL 30 MINUTES PRECEDING AND CURRENT ROW)"""
    )
    spark.catalog.dropTempView("hot_ticks")
    differ = found.join(plain, ["symbol", "event_seq_nb"]).where("mov_avg_pr <> expected")
    assert differ.count() == 0
    hot = found.where("symbol = 'HOT'").toPandas().sort_values("event_tm")
    price = hot["trade_pr"].astype(float)
    expected = price.groupby(hot["event_tm"]).sum().cumsum() / (
        price.groupby(hot["event_tm"]).count().cumsum()
    )
    assert (hot["mov_avg_pr"] - hot["event_tm"].map(expected)).abs().max() == 0
