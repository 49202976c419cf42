from tables import DAY, at, quotes, trades, values
from tapeline.operators.corrections import keep_latest
from tapeline.operators.enrichment import combine, fill_latest_eod, filter_quotes, join_close
from tapeline.operators.moving_average import moving_average
from tapeline.operators.prices import last_price
from tapeline.plans.jobs import enrich_quotes, enrich_quotes_eod
from tapeline.schemas import COMBINED_COLUMNS, ENRICHED_COLUMNS

TRADES = [("A", "N", "09:10:00", 1, "1"), ("A", "N", "09:30:00", 2, "2")]
QUOTES = [("A", "N", "09:00:00", 3), ("A", "N", "09:20:00", 5)]


def combined(spark, trade_rows, quote_rows, **options):
    averaged = moving_average(trades(spark, trade_rows))
    return combine(averaged, keep_latest(quotes(spark, quote_rows)), **options)


def test_combine_lines_up_both_tables(spark):
    found = combined(spark, TRADES, QUOTES)
    assert found.columns == list(COMBINED_COLUMNS)
    assert values(found, "event_seq_nb", "ask_size", "latest", "trade_pr") == [
        (1, None, None, 1.0), (2, None, None, 2.0),
        (3, 6, at("09:00:00"), None), (5, 6, at("09:20:00"), None),
    ]
    with_bid = combined(spark, TRADES, QUOTES, include_bid_pr=True)
    assert values(with_bid, "event_seq_nb", "bid_pr") == [(1, None), (2, None), (3, 9.9), (5, 9.9)]


def test_combine_collapses_equal_rows_only(spark):
    """Trades lose their arrival time, so versions of equal price become one."""
    rows = [
        ("A", "N", "09:10:00", 1, "1", "09:10:01"),
        ("A", "N", "09:10:00", 1, "1", "09:10:02"),
        ("A", "N", "09:10:00", 1, "3", "09:10:03"),
    ]
    found = combine(moving_average(trades(spark, rows)), keep_latest(quotes(spark, [])))
    assert len(values(found, "trade_pr")) == 2


def test_filter_quotes_needs_an_ask_size(spark):
    rows = [*QUOTES, ("A", "N", "09:25:00", 6, "09:25:00", DAY, None)]
    assert values(filter_quotes(combined(spark, TRADES, rows)), "event_seq_nb") == [(3,), (5,)]


def test_fill_latest_eod_takes_the_last_row_of_the_key(spark):
    found = fill_latest_eod(combined(spark, TRADES, QUOTES))
    assert values(found, "event_seq_nb", "latest_trade_pr", "mov_avg_pr") == [
        (1, 2.0, 1.5), (2, 2.0, 1.5), (3, 2.0, 1.5), (5, 2.0, 1.5),
    ]
    for late in ("09:30:00", "09:40:00"):
        after = fill_latest_eod(combined(spark, TRADES, [*QUOTES, ("A", "N", late, 7)]))
        assert {v for _, v in values(after, "event_seq_nb", "latest_trade_pr")} == {None}


def test_fill_latest_eod_ties_stay_within_their_key(spark):
    rows = [("A", "N", "09:30:00", 1, "1"), ("B", "N", "09:30:00", 1, "2")]
    found = fill_latest_eod(combined(spark, rows, [("A", "N", "09:00:00", 3)]))
    assert values(found, "symbol", "event_seq_nb", "latest_trade_pr") == [
        ("A", 1, 1.0), ("A", 3, 1.0), ("B", 1, 2.0),
    ]


def test_join_close_keeps_every_quote(spark):
    closes = last_price(trades(spark, TRADES))
    rows = [*QUOTES, ("Z", "N", "09:00:00", 9)]
    found = join_close(quotes(spark, rows), closes)
    assert values(found, "event_seq_nb", "close_pr") == [(3, 2.0), (5, 2.0), (9, None)]


def test_enriched_quotes(spark):
    days = ("2020-08-04", DAY)
    trade_rows = [(*row, row[2], day) for row in TRADES for day in days]
    quote_rows = [(*row, row[2], day) for row in QUOTES for day in days]
    quote_rows.append(("A", "N", "09:40:00", 8, "09:40:00", DAY, None))
    kept = keep_latest(quotes(spark, quote_rows))
    found = enrich_quotes(keep_latest(trades(spark, trade_rows)), kept)
    assert found.columns == list(ENRICHED_COLUMNS)
    assert values(
        found, "trade_dt", "event_seq_nb", "latest_trade_pr", "mov_avg_pr", "close_pr", "ask_size"
    ) == [
        ("2020-08-04", 3, None, None, None, 6), ("2020-08-04", 5, 1.0, 1.0, None, 6),
        (DAY, 3, None, None, 2.0, 6), (DAY, 5, 1.0, 1.0, 2.0, 6), (DAY, 8, 2.0, 1.5, 2.0, None),
    ]


def test_enriched_quotes_eod(spark):
    found = enrich_quotes_eod(
        keep_latest(trades(spark, TRADES)), keep_latest(quotes(spark, QUOTES))
    )
    assert found.columns == list(ENRICHED_COLUMNS)
    assert values(found, "event_seq_nb", "latest_trade_pr", "mov_avg_pr", "close_pr") == [
        (3, 2.0, 1.5, 2.0), (5, 2.0, 1.5, 2.0),
    ]
