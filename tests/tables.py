"""Small typed tables for the tests, all on one day unless given a date."""

from decimal import Decimal

DAY = "2020-08-05"
TRADE_COLUMNS = (
    "trade_dt string, symbol string, exchange string, event_tm string, event_seq_nb bigint, "
    "arrival_tm string, trade_pr string, bid_size bigint"
)
QUOTE_COLUMNS = (
    "trade_dt string, symbol string, exchange string, event_tm string, event_seq_nb bigint, "
    "arrival_tm string, bid_pr string, bid_size bigint, ask_pr string, ask_size bigint"
)


def at(time, day=DAY):
    return None if time is None else f"{day} {time}"


def _typed(rows):
    types = {
        "trade_dt": "date",
        "event_tm": "timestamp_ntz",
        "arrival_tm": "timestamp_ntz",
        "trade_pr": "decimal(18,4)",
        "bid_pr": "decimal(18,4)",
        "ask_pr": "decimal(18,4)",
    }
    return rows.withColumns({c: rows[c].cast(t) for c, t in types.items() if c in rows.columns})


def trades(spark, rows):
    """Rows of (symbol, exchange, event time, sequence, price[, arrival[, date]])."""
    full = []
    for symbol, exchange, time, seq, price, *more in rows:
        arrival = more[0] if more else time
        day = more[1] if len(more) > 1 else DAY
        full.append((day, symbol, exchange, at(time, day), seq, at(arrival, day), price, 100))
    return _typed(spark.createDataFrame(full, TRADE_COLUMNS))


def quotes(spark, rows):
    """Rows of (symbol, exchange, event time, sequence[, arrival[, date[, ask size]]])."""
    full = []
    for symbol, exchange, time, seq, *more in rows:
        arrival = more[0] if more else time
        day = more[1] if len(more) > 1 else DAY
        size = more[2] if len(more) > 2 else 6
        full.append(
            (day, symbol, exchange, at(time, day), seq, at(arrival, day), "9.9", 5, "10.1", size)
        )
    return _typed(spark.createDataFrame(full, QUOTE_COLUMNS))


def values(rows, *columns):
    """Rows as sorted tuples, decimals as floats and times as text."""

    def plain(value):
        if isinstance(value, Decimal):
            return float(value)
        if hasattr(value, "isoformat"):
            return str(value)
        return value

    found = [tuple(plain(v) for v in row) for row in rows.select(*columns).collect()]
    return sorted(found, key=repr)
