import re

from pyspark.sql import functions as F

from tables import DAY, at, trades, values
from tapeline.operators.corrections import (
    annotate_latest,
    keep_latest,
    rejected_rows,
    typed_rows,
)
from tapeline.schemas import EVENT_KEY, QUOTE_TYPES, TRADE_TYPES

VERSIONS = [
    ("A", "N", "09:00:00", 1, "10", "09:00:01"),
    ("A", "N", "09:00:00", 1, "11", "09:00:02"),
    (None, "N", "09:00:00", 1, "12", "09:00:03"),
]


def test_annotate_keeps_versions_and_drops_null_keys(spark):
    found = annotate_latest(trades(spark, VERSIONS))
    assert found.columns == [*EVENT_KEY, "arrival_tm", "trade_pr", "bid_size", "latest"]
    assert values(found, "trade_pr", "latest") == [(10.0, at("09:00:02")), (11.0, at("09:00:02"))]


def test_keep_latest(spark):
    found = keep_latest(trades(spark, VERSIONS))
    assert values(found, "trade_pr", "arrival_tm", "latest") == [
        (11.0, at("09:00:02"), at("09:00:02"))
    ]
    assert values(keep_latest(found), *found.columns) == values(found, *found.columns)


def test_keep_latest_is_settled_on_equal_and_missing_arrivals(spark):
    rows = [
        ("A", "N", "09:00:00", 1, "10", "09:00:02"),
        ("A", "N", "09:00:00", 1, "12", "09:00:02"),
        ("A", "N", "09:00:00", 1, "99", None),
        ("B", "N", "09:00:00", 1, "7", None),
    ]
    for order in (rows, rows[::-1]):
        assert values(keep_latest(trades(spark, order)), "symbol", "trade_pr") == [
            ("A", 12.0),
            ("B", 7.0),
        ]


def test_sequence_numbers_are_numbers(spark):
    events = text_events(spark, [{"event_seq_nb": "9"}, {"event_seq_nb": "10"}])
    assert values(typed_rows(events, TRADE_TYPES), "event_seq_nb") == [(10,), (9,)]


def text_events(spark, changes):
    base = {
        "trade_dt": DAY,
        "symbol": "A",
        "exchange": "N",
        "event_tm": at("09:00:00"),
        "event_seq_nb": "1",
        "arrival_tm": at("09:00:01"),
        "trade_pr": "10.5",
        "bid_pr": "9.5",
        "bid_size": "100",
        "ask_pr": "9.6",
        "ask_size": "200",
    }
    columns = list(base)
    rows = [tuple({**base, **change}[c] for c in columns) for change in changes]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_texts_that_do_not_cast_are_rejected_and_kept_as_text(spark):
    changes = [
        {},
        {"trade_pr": "n/a"},
        {"trade_pr": None},
        {"event_tm": "soon"},
        {"bid_size": "100.5"},
        {"bid_size": "1.0E2"},
        {"trade_dt": "??"},
    ]
    events = text_events(spark, changes)
    assert values(typed_rows(events, TRADE_TYPES), "trade_pr", "bid_size") == [
        (10.5, 100), (10.5, 100), (None, 100),
    ]
    rejected = rejected_rows(events, TRADE_TYPES)
    assert rejected.columns == list(TRADE_TYPES)
    assert rejected.count() == 4
    assert values(rejected.where("trade_pr = 'n/a'"), "event_seq_nb") == [("1",)]
    assert rejected_rows(text_events(spark, [{"ask_size": "x"}]), QUOTE_TYPES).count() == 1


def test_each_text_is_cast_once(spark):
    events = text_events(spark, [{}])
    for rows in (keep_latest(typed_rows(events, TRADE_TYPES)), rejected_rows(events, TRADE_TYPES)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert len(re.findall(r"cast\(trade_dt#\d+ as date\)", plan)) == 1
        assert len(re.findall(r"cast\(trade_pr#\d+ as decimal\(38,20\)\)", plan)) == 1


def test_usual_times_cast_as_all_others(spark):
    texts = [f"{DAY} 09:00:00", f"{DAY}T09:00:00", f" {DAY} 09:00:00.000 ", f"{DAY} 09:00:00\n"]
    events = text_events(spark, [{"event_tm": text} for text in texts])
    assert values(typed_rows(events, TRADE_TYPES), "event_tm") == [(at("09:00:00"),)] * 4
    wrong = [f"{DAY} 25:00:00", "2020-02-30 09:00:00", f"{DAY} 09:00:00.", f"{DAY} 09:00:00Z", f"{DAY} 09:00:00+01"]
    rejected = rejected_rows(text_events(spark, [{"event_tm": text} for text in wrong]), TRADE_TYPES)
    kept = typed_rows(text_events(spark, [{"event_tm": text} for text in wrong]), TRADE_TYPES)
    assert values(rejected, "event_tm") == sorted((text,) for text in wrong if text[-1] != ".")
    assert values(kept, "event_tm") == [(at("09:00:00"),)]  # Spark casts a text that ends with the dot


def test_time_only_text_belongs_to_the_trade_date(spark):
    events = text_events(spark, [{"event_tm": "09:30:00.5", "arrival_tm": " 9:31:00"}])
    assert values(typed_rows(events, TRADE_TYPES), "event_tm", "arrival_tm") == [
        (at("09:30:00.500000"), at("09:31:00"))
    ]


def test_one_event_with_very_many_versions(spark):
    """A third of all rows are versions of one event."""
    n = 30_000
    ids = spark.range(n)
    hot = F.col("id") % 3 == 0
    rows = ids.select(
        F.lit(DAY).cast("date").alias("trade_dt"),
        F.lit("A").alias("symbol"),
        F.lit("N").alias("exchange"),
        F.lit(at("09:00:00")).cast("timestamp_ntz").alias("event_tm"),
        F.when(hot, -1).otherwise(F.col("id")).alias("event_seq_nb"),
        (F.lit(at("09:00:00")).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias(
            "arrival_tm"
        ),
        F.col("id").cast("decimal(18,4)").alias("trade_pr"),
    )
    kept = keep_latest(rows)
    assert kept.count() == n - n // 3 + 1
    assert values(kept.where("event_seq_nb = -1"), "trade_pr") == [(float(n - 3),)]
    annotated = annotate_latest(rows)
    assert annotated.count() == n
    latest = annotated.where("event_seq_nb = -1").select("latest").distinct().collect()
    assert len(latest) == 1
