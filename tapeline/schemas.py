"""Column lists, keys and types of the message, trade and quote tables."""

from collections.abc import Mapping

from pyspark.sql import types as T

# The all-text event table that ingestion writes, one row per message line.
# Its column names and their order are fixed values.
COMMON_COLUMNS = (
    "trade_dt",
    "rec_type",
    "symbol",
    "exchange",
    "event_tm",
    "event_seq_nb",
    "arrival_tm",
    "trade_pr",
    "bid_pr",
    "bid_size",
    "ask_pr",
    "ask_size",
    "partition",
)
COMMON_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in COMMON_COLUMNS])

TRADE, QUOTE, BAD = "T", "Q", "B"

EVENT_KEY = ("trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb")
GROUP_KEY = ("symbol", "exchange")
DAY_GROUP_KEY = ("trade_dt", *GROUP_KEY)
DAY_SYMBOL_KEY = ("trade_dt", "symbol")

PRICE = "decimal(18,4)"
PRICE_SUM = "decimal(38,4)"

_EVENT_TYPES = {
    "trade_dt": "date",
    "symbol": "string",
    "exchange": "string",
    "event_tm": "timestamp_ntz",
    "event_seq_nb": "bigint",
    "arrival_tm": "timestamp_ntz",
}
# A trade's size is kept under the name bid_size: the event table has no
# column of its own for it.
TRADE_TYPES = {**_EVENT_TYPES, "trade_pr": PRICE, "bid_size": "bigint"}
QUOTE_TYPES = {
    **_EVENT_TYPES,
    "bid_pr": PRICE,
    "bid_size": "bigint",
    "ask_pr": PRICE,
    "ask_size": "bigint",
}


def schema_of(types: Mapping[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in types.items()))


# The stored tables, with their partition columns.
SOURCE_KEY = ("src_date", "src_format", "src_exchange")
_SOURCE_TYPES = {"src_date": "date", "src_format": "string", "src_exchange": "string"}
EVENT_TABLE_TYPES = {
    **{name: "string" for name in COMMON_COLUMNS if name != "partition"},
    **_SOURCE_TYPES,
    "trade_day": "date",
    "partition": "string",
}
TRADE_TABLE_TYPES = {**TRADE_TYPES, "latest": "timestamp_ntz"}
QUOTE_TABLE_TYPES = {**QUOTE_TYPES, "latest": "timestamp_ntz"}
CLOSE_TABLE_TYPES = {"trade_dt": "date", "symbol": "string", "exchange": "string", "close_pr": PRICE}
CARRIED_TABLE_TYPES = {**CLOSE_TABLE_TYPES, "month": "date"}

# Trades with their average, and quotes, lined up under one another.
COMBINED_COLUMNS = (
    *EVENT_KEY,
    "arrival_tm",
    "bid_size",
    "ask_pr",
    "ask_size",
    "latest",
    "trade_pr",
    "mov_avg_pr",
)

ENRICHED_COLUMNS = (
    "symbol",
    "exchange",
    "trade_dt",
    "event_tm",
    "event_seq_nb",
    "arrival_tm",
    "bid_size",
    "ask_pr",
    "ask_size",
    "latest",
    "latest_trade_pr",
    "mov_avg_pr",
    "close_pr",
)

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("job_name", T.StringType(), False),
        T.StructField("row_key", T.StringType(), False),
        T.StructField("ts", T.TimestampType(), False),
        T.StructField("job_id", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("error", T.StringType(), True),
        T.StructField("run_id", T.StringType(), True),
    ]
)
