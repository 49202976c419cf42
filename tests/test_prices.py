from pyspark.sql import functions as F

from tables import at, quotes, trades, values
from tapeline.operators.prices import last_event_time, last_price, last_price_literal, prev_close

TICKS = [
    ("A", "N", "09:00:00.0", 1, "10"),
    ("A", "Q", "09:30:00.0", 2, "20"),
    ("A", "N", "09:30:00.1", 3, "30"),
    ("A", "N", "09:40:00.0", 4, "31"),
    ("B", "N", "09:30:00.1", 1, "99"),
    ("B", "N", "09:40:00.0", 2, "98"),
    ("B", "N", None, 5, "97"),
]
FRIDAY, MONDAY, TUESDAY = "2020-08-07", "2020-08-10", "2020-08-11"


def test_last_event_time(spark):
    found = last_event_time(trades(spark, TICKS))
    assert values(found, "symbol", "exchange", "last_event_tm") == [
        ("A", "N", at("09:40:00")), ("A", "Q", at("09:30:00")), ("B", "N", at("09:40:00")),
    ]


def test_last_price_per_key(spark):
    assert values(last_price(trades(spark, TICKS)), "symbol", "exchange", "close_pr") == [
        ("A", "N", 31.0), ("A", "Q", 20.0), ("B", "N", 98.0),
    ]


def test_last_price_literal_matches_on_time_alone(spark):
    found = last_price_literal(trades(spark, TICKS))
    assert values(found, "symbol", "exchange", "close_pr", "n_groups") == [
        ("A", "N", 31.0, 2), ("A", "Q", 20.0, 1), ("B", "N", 98.0, 2),
    ]


def test_greater_sequence_number_is_later(spark):
    rows = [("A", "N", "09:00:00", 9, "1"), ("A", "N", "09:00:00", 10, "2")]
    assert values(last_price(trades(spark, rows)), "close_pr") == [(2.0,)]


def closes_and_days(spark):
    closes = last_price(
        trades(
            spark,
            [
                ("A", "N", "15:00:00", 1, "10", "15:00:00", FRIDAY),
                ("A", "N", "15:00:00", 1, "11", "15:00:00", MONDAY),
                ("B", "N", "15:00:00", 1, "50", "15:00:00", FRIDAY),
            ],
        )
    )
    days = quotes(
        spark,
        [
            ("A", "N", "10:00:00", 1, "10:00:00", FRIDAY),
            ("A", "N", "10:00:00", 1, "10:00:00", MONDAY),
            ("A", "N", "10:00:00", 1, "10:00:00", TUESDAY),
            ("A", "N", "10:01:00", 2, "10:01:00", TUESDAY),
            ("C", "N", "10:00:00", 1, "10:00:00", TUESDAY),
        ],
    )
    return closes, days


def test_previous_close_is_of_the_last_trading_day(spark):
    found = prev_close(*closes_and_days(spark))
    assert values(found, "symbol", "trade_dt", "close_pr") == [
        ("A", FRIDAY, None), ("A", MONDAY, 10.0), ("A", TUESDAY, 11.0), ("C", TUESDAY, None),
    ]


def test_previous_close_of_the_calendar_day_before(spark):
    found = prev_close(*closes_and_days(spark), calendar_day=True)
    assert values(found, "symbol", "trade_dt", "close_pr") == [
        ("A", FRIDAY, None), ("A", MONDAY, None), ("A", TUESDAY, 11.0), ("C", TUESDAY, None),
    ]


def test_closes_may_be_missing_on_a_trading_day(spark):
    closes, days = closes_and_days(spark)
    holes = closes.withColumn(
        "close_pr", F.when(F.col("trade_dt") != F.lit(MONDAY).cast("date"), F.col("close_pr"))
    )
    assert ("A", TUESDAY, 10.0) in values(
        prev_close(holes, days), "symbol", "trade_dt", "close_pr"
    )
