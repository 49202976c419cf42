"""SQL for DuckDB with the same results as the registered queries.

Written from the definitions rather than after the Spark code: plain range
frames, as-of joins and row numbers instead of cells, carries and argmax.
"""

_RAW = """
base AS (
  SELECT CAST(ts AS DATE) AS trade_dt,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'T'
              WHEN event_type IN ('view', 'signup') THEN 'Q' ELSE 'X' END AS rec_type,
         concat('S', CAST(user_id % 4 AS VARCHAR)) AS symbol,
         CASE WHEN event_id % 2 = 0 THEN 'NYSE' ELSE 'NASDAQ' END AS exchange,
         ts AS event_tm, event_id AS event_seq_nb, ts + INTERVAL '1' SECOND AS arrival_tm,
         CAST(value AS DECIMAL(18,4)) AS px, event_id % 100 AS sz
  FROM events),
raw AS (
  SELECT * FROM base
  UNION ALL
  SELECT trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb,
         arrival_tm + INTERVAL '5' SECOND, CAST(px + 1 AS DECIMAL(18,4)), sz
  FROM base WHERE event_seq_nb % 10 = 0)"""

_TABLES = f"""{_RAW},
trade AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm,
         px AS trade_pr, sz AS bid_size
  FROM raw WHERE rec_type = 'T'),
quote AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, px AS bid_pr,
         sz AS bid_size, CAST(px + 0.05 AS DECIMAL(18,4)) AS ask_pr, sz + 1 AS ask_size
  FROM raw WHERE rec_type = 'Q'),
latest_trade AS (
  SELECT *, arrival_tm AS latest FROM trade QUALIFY row_number() OVER (
    PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb
    ORDER BY arrival_tm DESC) = 1),
latest_quote AS (
  SELECT *, arrival_tm AS latest FROM quote QUALIFY row_number() OVER (
    PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb
    ORDER BY arrival_tm DESC) = 1),
annotated_quote AS (
  SELECT *, max(arrival_tm) OVER (
    PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb) AS latest
  FROM quote)"""

_KEY = (
    "CAST(trade_dt AS VARCHAR) AS trade_dt, symbol, exchange, "
    "CAST(event_tm AS VARCHAR) AS event_tm, event_seq_nb"
)
_TRADE_SHOWN = (
    f"{_KEY}, CAST(arrival_tm AS VARCHAR) AS arrival_tm, "
    "CAST(trade_pr AS DOUBLE) AS trade_pr, bid_size"
)
_QUOTE_SHOWN = (
    f"{_KEY}, CAST(arrival_tm AS VARCHAR) AS arrival_tm, CAST(bid_pr AS DOUBLE) AS bid_pr, "
    "bid_size, CAST(ask_pr AS DOUBLE) AS ask_pr, ask_size"
)
_LATEST = "CAST(latest AS VARCHAR) AS latest"


def _average(keys: str, hours: str) -> str:
    """Average over a plain range frame."""
    frame = (
        f"OVER (PARTITION BY {keys} ORDER BY event_tm "
        f"RANGE BETWEEN INTERVAL '{hours}' PRECEDING AND CURRENT ROW)"
    )
    return f"CAST(sum(trade_pr) {frame} AS DOUBLE) / count(trade_pr) {frame}"


def _moving_average(keys: str, length: str) -> str:
    return f"""WITH {_TABLES}
SELECT {_KEY}, CAST(trade_pr AS DOUBLE) AS trade_pr, {_average(keys, length)} AS mov_avg_pr
FROM latest_trade"""


def _combined(keys: str, quotes: str, bid: bool = False) -> str:
    return f"""
averaged AS (SELECT *, {_average(keys, "30 MINUTES")} AS mov_avg_pr FROM latest_trade),
combined AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, NULL AS arrival_tm,
         NULL AS bid_size, NULL AS ask_pr, NULL AS ask_size, NULL AS latest,
         trade_pr, mov_avg_pr{", NULL AS bid_pr" if bid else ""} FROM averaged
  UNION
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, bid_size,
         ask_pr, ask_size, latest, NULL, NULL{", bid_pr" if bid else ""} FROM {quotes})"""


_FILLED_SHOWN = (
    f"{_KEY}, CAST(arrival_tm AS VARCHAR) AS arrival_tm, bid_size, "
    f"CAST(ask_pr AS DOUBLE) AS ask_pr, ask_size, {_LATEST}"
)
_COMBINED_SHOWN = f"{_FILLED_SHOWN}, CAST(trade_pr AS DOUBLE) AS trade_pr, mov_avg_pr"

_CLOSES = """
close_of AS (
  SELECT trade_dt, symbol, exchange, trade_pr AS close_pr FROM {trades} QUALIFY row_number()
    OVER (PARTITION BY trade_dt, symbol, exchange
          ORDER BY event_tm DESC, event_seq_nb DESC, arrival_tm DESC) = 1)"""

_LAST_OF_DAY = """
last_of_day AS (
  SELECT trade_dt, symbol, exchange, trade_pr AS latest_trade_pr, mov_avg_pr
  FROM combined QUALIFY row_number() OVER (
    PARTITION BY trade_dt, symbol, exchange
    ORDER BY event_tm DESC, ask_size IS NOT NULL DESC, event_seq_nb DESC, arrival_tm DESC) = 1)"""

# Message lines: which are complete, and the text of their fields.
_CSV_OK = "rec_type <> 'X' AND event_seq_nb % 46 <> 0 AND event_seq_nb % 74 <> 0"
_JSON_OK = "rec_type <> 'X' AND event_seq_nb % 51 <> 0 AND event_seq_nb % 69 <> 0"
_CSV_PRICE = "CASE WHEN event_seq_nb % 58 = 0 THEN 'n/a' ELSE CAST(px AS VARCHAR) END"
_JSON_BID = (
    "CASE WHEN rec_type = 'Q' AND event_seq_nb % 57 = 0 THEN NULL ELSE CAST(px AS VARCHAR) END"
)


def _messages(ok: str, price: str, where: str = "true") -> str:
    """Common events of one message format."""
    return f"""
  SELECT CASE WHEN ok THEN CAST(trade_dt AS VARCHAR) END AS trade_dt,
         CASE WHEN ok THEN rec_type END AS rec_type,
         CASE WHEN ok THEN symbol END AS symbol,
         CASE WHEN ok THEN exchange END AS exchange,
         CASE WHEN ok THEN CAST(event_tm AS VARCHAR) END AS event_tm,
         CASE WHEN ok THEN CAST(event_seq_nb AS VARCHAR) END AS event_seq_nb,
         CASE WHEN ok THEN CAST(arrival_tm AS VARCHAR) END AS arrival_tm,
         CASE WHEN ok AND rec_type = 'T' THEN price END AS trade_pr,
         CASE WHEN ok AND rec_type = 'Q' THEN price END AS bid_pr,
         CASE WHEN ok THEN CAST(sz AS VARCHAR) END AS bid_size,
         CASE WHEN ok AND rec_type = 'Q'
              THEN CAST(CAST(px + 0.05 AS DECIMAL(18,4)) AS VARCHAR) END AS ask_pr,
         CASE WHEN ok AND rec_type = 'Q' THEN CAST(sz + 1 AS VARCHAR) END AS ask_size,
         CASE WHEN ok THEN rec_type ELSE 'B' END AS partition,
         CAST(trade_dt AS VARCHAR) AS src_date
  FROM (SELECT *, ({ok}) AS ok, {price} AS price FROM raw WHERE {where})"""


_CSV = _messages(_CSV_OK, _CSV_PRICE)
_JSON = _messages(_JSON_OK, _JSON_BID)
_ALL = (
    _messages(_CSV_OK, _CSV_PRICE, "exchange = 'NYSE'")
    + "\n  UNION ALL"
    + _messages(_JSON_OK, _JSON_BID, "exchange = 'NASDAQ'")
)

_EVENT = "trade_dt, symbol, exchange, event_tm, CAST(event_seq_nb AS BIGINT) AS event_seq_nb"
_TRADE_PROPER = "partition = 'T' AND trade_pr <> 'n/a'"
_QUOTE_PROPER = "partition = 'Q' AND bid_pr IS DISTINCT FROM 'n/a'"
_TRADE_TYPED = f"""{_EVENT}, arrival_tm, CAST(trade_pr AS DOUBLE) AS trade_pr,
  CAST(bid_size AS BIGINT) AS bid_size"""
_QUOTE_TYPED = f"""{_EVENT}, arrival_tm, CAST(bid_pr AS DOUBLE) AS bid_pr,
  CAST(bid_size AS BIGINT) AS bid_size, CAST(ask_pr AS DOUBLE) AS ask_pr,
  CAST(ask_size AS BIGINT) AS ask_size"""
_NEWEST = """QUALIFY row_number() OVER (
    PARTITION BY trade_dt, symbol, exchange, event_tm, event_seq_nb
    ORDER BY CAST(arrival_tm AS TIMESTAMP) DESC) = 1"""


def _read(columns: str, proper: str) -> str:
    return f"WITH {_RAW}, messages AS ({_ALL}) SELECT {columns} FROM messages WHERE {proper}"


def _load(columns: str, proper: str) -> str:
    return f"""WITH {_RAW}, messages AS ({_ALL}),
typed AS (SELECT {columns} FROM messages WHERE {proper})
SELECT *, arrival_tm AS latest FROM typed {_NEWEST}"""


_CSV_LINE = f"""CASE WHEN event_seq_nb % 74 = 0 THEN '' ELSE
    concat_ws(',', CAST(trade_dt AS VARCHAR), CAST(arrival_tm AS VARCHAR), rec_type, symbol,
      CAST(event_tm AS VARCHAR), CAST(event_seq_nb AS VARCHAR), exchange, {_CSV_PRICE},
      CASE WHEN rec_type = 'Q' OR event_seq_nb % 46 <> 0 THEN CAST(sz AS VARCHAR) END,
      CASE WHEN rec_type = 'Q' THEN CAST(CAST(px + 0.05 AS DECIMAL(18,4)) AS VARCHAR) END,
      CASE WHEN rec_type = 'Q' AND event_seq_nb % 46 <> 0 THEN CAST(sz + 1 AS VARCHAR) END) END"""

_JSON_WHOLE = """concat('{',
    CASE WHEN rec_type = 'Q' AND event_seq_nb % 57 = 0 THEN '"bid_pr":null,' ELSE '' END,
    '"trade_dt":"', CAST(trade_dt AS VARCHAR), '","event_type":"', rec_type,
    '","symbol":"', symbol, '","exchange":"', exchange,
    '","event_tm":"', CAST(event_tm AS VARCHAR), '"',
    CASE WHEN rec_type = 'Q' AND event_seq_nb % 51 = 0 THEN ''
         ELSE concat(',"event_seq_nb":', event_seq_nb) END,
    ',"file_tm":"', CAST(arrival_tm AS VARCHAR), '"',
    CASE WHEN rec_type = 'T' AND event_seq_nb % 51 <> 0
         THEN concat(',"execution_id":"x', event_seq_nb, '"') ELSE '' END,
    CASE WHEN rec_type <> 'Q'
         THEN concat(',"price":"', CAST(px AS VARCHAR), '","size":', sz) ELSE '' END,
    CASE WHEN rec_type = 'Q'
         THEN concat(',"bid_size":"', sz, '","ask_pr":"',
                     CAST(CAST(px + 0.05 AS DECIMAL(18,4)) AS VARCHAR),
                     '","ask_size":"', sz + 1, '"') ELSE '' END,
    CASE WHEN rec_type = 'Q' AND event_seq_nb % 57 <> 0
         THEN concat(',"bid_pr":"', CAST(px AS VARCHAR), '"') ELSE '' END,
    '}')"""
_JSON_LINE = f"""CASE WHEN event_seq_nb % 69 = 0
    THEN left({_JSON_WHOLE}, length({_JSON_WHOLE}) - 12) ELSE {_JSON_WHOLE} END"""


# The latest trades and quotes of the message lines.
_DAILY_EVENT = """CAST(trade_dt AS DATE) AS trade_dt, symbol, exchange,
  CAST(event_tm AS TIMESTAMP) AS event_tm, CAST(event_seq_nb AS BIGINT) AS event_seq_nb,
  CAST(arrival_tm AS TIMESTAMP) AS arrival_tm, CAST(arrival_tm AS TIMESTAMP) AS latest,
  CAST(bid_size AS BIGINT) AS bid_size"""
_DAILY_TABLES = f"""{_RAW},
messages AS ({_ALL}),
latest_trade AS (
  SELECT {_DAILY_EVENT}, CAST(trade_pr AS DECIMAL(18,4)) AS trade_pr
  FROM messages WHERE {_TRADE_PROPER} {_NEWEST}),
latest_quote AS (
  SELECT {_DAILY_EVENT}, CAST(bid_pr AS DECIMAL(18,4)) AS bid_pr,
         CAST(ask_pr AS DECIMAL(18,4)) AS ask_pr, CAST(ask_size AS BIGINT) AS ask_size
  FROM messages WHERE {_QUOTE_PROPER} {_NEWEST})"""


def _enriched(earlier: str, bid: bool = False, tables: str = _TABLES) -> str:
    """Quotes with as-of values and the previous close."""
    return f"""WITH {tables}, {_CLOSES.format(trades="latest_trade")},
averaged AS (
  SELECT *, {_average("trade_dt, symbol", "30 MINUTES")} AS mov_avg_pr FROM latest_trade),
filled AS (
  SELECT q.*, t.trade_pr AS latest_trade_pr, t.mov_avg_pr
  FROM latest_quote q ASOF LEFT JOIN averaged t
    ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.exchange = t.exchange
   AND q.event_tm >= t.event_tm)
SELECT CAST(q.trade_dt AS VARCHAR) AS trade_dt, q.symbol, q.exchange,
       CAST(q.event_tm AS VARCHAR) AS event_tm, q.event_seq_nb,
       CAST(q.arrival_tm AS VARCHAR) AS arrival_tm, q.bid_size,
       CAST(q.ask_pr AS DOUBLE) AS ask_pr, q.ask_size, CAST(q.latest AS VARCHAR) AS latest,
       CAST(q.latest_trade_pr AS DOUBLE) AS latest_trade_pr, q.mov_avg_pr,
       CAST(c.close_pr AS DOUBLE) AS close_pr{", CAST(q.bid_pr AS DOUBLE) AS bid_pr" if bid else ""}
FROM filled q {earlier}"""


_EARLIER_DAY = """ASOF LEFT JOIN close_of c
  ON q.symbol = c.symbol AND q.exchange = c.exchange AND q.trade_dt > c.trade_dt"""
_DAY_BEFORE = """LEFT JOIN close_of c
  ON q.symbol = c.symbol AND q.exchange = c.exchange AND q.trade_dt = c.trade_dt + 1"""


def _previous(earlier: str) -> str:
    return f"""WITH {_TABLES}, {_CLOSES.format(trades="trade")},
days AS (SELECT DISTINCT trade_dt, symbol, exchange FROM quote)
SELECT CAST(q.trade_dt AS VARCHAR) AS trade_dt, q.symbol, q.exchange,
       CAST(c.close_pr AS DOUBLE) AS close_pr
FROM days q {earlier}"""


_LOG = """
log AS (
  SELECT concat('job', user_id % 4, '-', CAST(CAST(ts AS DATE) AS VARCHAR)) AS job_id, ts,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success'
              WHEN 'click' THEN 'running' ELSE 'starting' END AS status
  FROM events)"""

_COMMON = (
    "trade_dt, rec_type, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr, "
    "bid_pr, bid_size, ask_pr, ask_size, partition"
)

ORACLE: dict[str, str] = {
    "ingest_csv": f"WITH {_RAW}, messages AS ({_CSV}) SELECT {_COMMON} FROM messages",
    "ingest_json": f"WITH {_RAW}, messages AS ({_JSON}) SELECT {_COMMON} FROM messages",
    "ingest_all": f"WITH {_RAW}, messages AS ({_ALL}) SELECT {_COMMON} FROM messages",
    "bad_records": f"""WITH {_RAW}
SELECT 'csv' AS source, {_CSV_LINE} AS raw_line FROM raw
WHERE exchange = 'NYSE' AND NOT ({_CSV_OK})
UNION ALL
SELECT 'json' AS source, {_JSON_LINE} AS raw_line FROM raw
WHERE exchange = 'NASDAQ' AND NOT ({_JSON_OK})""",
    "source_files": f"""WITH {_RAW}
SELECT CASE WHEN exchange = 'NYSE' THEN 'csv' ELSE 'json' END AS src_format,
       CAST(trade_dt AS VARCHAR) AS src_date, exchange AS src_exchange, count(*) AS n_lines
FROM raw GROUP BY 1, 2, 3""",
    "partition_counts": f"""WITH {_RAW}, messages AS ({_ALL})
SELECT src_date, partition, count(*) AS n_events FROM messages GROUP BY src_date, partition""",
    "read_trades": _read(_TRADE_TYPED, _TRADE_PROPER),
    "read_quotes": _read(_QUOTE_TYPED, _QUOTE_PROPER),
    "rejected_trades": _read(
        "trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, trade_pr, bid_size",
        "partition = 'T' AND trade_pr = 'n/a'",
    ),
    "rejected_quotes": _read(
        "trade_dt, symbol, exchange, event_tm, event_seq_nb, arrival_tm, bid_pr, bid_size, "
        "ask_pr, ask_size",
        "partition = 'Q' AND bid_pr = 'n/a'",
    ),
    "load_trades": _load(_TRADE_TYPED, _TRADE_PROPER),
    "load_quotes": _load(_QUOTE_TYPED, _QUOTE_PROPER),
    "trades_on_date": f"""WITH {_TABLES}
SELECT {_TRADE_SHOWN} FROM trade WHERE trade_dt = DATE '2024-01-15'""",
    "annotate_latest": f"""WITH {_TABLES},
latest_of AS (
  SELECT trade_dt, symbol, exchange, event_tm, event_seq_nb, max(arrival_tm) AS latest
  FROM trade GROUP BY ALL)
SELECT {_TRADE_SHOWN}, {_LATEST}
FROM trade JOIN latest_of USING (trade_dt, symbol, exchange, event_tm, event_seq_nb)""",
    "annotate_latest_quotes": f"""WITH {_TABLES}
SELECT {_QUOTE_SHOWN}, {_LATEST} FROM annotated_quote""",
    "keep_latest": f"WITH {_TABLES} SELECT {_TRADE_SHOWN}, {_LATEST} FROM latest_trade",
    "keep_latest_quotes": f"WITH {_TABLES} SELECT {_QUOTE_SHOWN}, {_LATEST} FROM latest_quote",
    "moving_avg_30m": _moving_average("symbol", "30 MINUTES"),
    "moving_avg_6h": _moving_average("symbol", "6 HOURS"),
    "moving_avg_bucketed": _moving_average("symbol, exchange", "6 HOURS"),
    "last_event_time": f"""WITH {_TABLES}
SELECT symbol, exchange, CAST(max(event_tm) AS VARCHAR) AS last_event_tm
FROM trade GROUP BY symbol, exchange""",
    "last_price": f"""WITH {_TABLES}, {_CLOSES.format(trades="latest_trade")}
SELECT CAST(trade_dt AS VARCHAR) AS trade_dt, symbol, exchange,
       CAST(close_pr AS DOUBLE) AS close_pr FROM close_of""",
    "last_price_literal": f"""WITH {_TABLES},
last_times AS (
  SELECT trade_dt, max(event_tm) AS last_tm FROM latest_trade
  GROUP BY trade_dt, symbol, exchange),
shared_times AS (SELECT trade_dt, last_tm, count(*) AS n_groups FROM last_times GROUP BY ALL)
SELECT CAST(t.trade_dt AS VARCHAR) AS trade_dt, t.symbol, t.exchange,
       CAST(t.trade_pr AS DOUBLE) AS close_pr, l.n_groups
FROM latest_trade t JOIN shared_times l ON t.trade_dt = l.trade_dt AND t.event_tm = l.last_tm""",
    "prev_close": _previous(_EARLIER_DAY),
    "prev_close_calendar_day": _previous(_DAY_BEFORE),
    "combine": f"""WITH {_TABLES}, {_combined("symbol", "annotated_quote")}
SELECT {_COMBINED_SHOWN} FROM combined""",
    "combine_with_bid": f"""WITH {_TABLES}, {_combined("symbol", "annotated_quote", bid=True)}
SELECT {_COMBINED_SHOWN}, CAST(bid_pr AS DOUBLE) AS bid_pr FROM combined""",
    "filter_quotes": f"""WITH {_TABLES}, {_combined("symbol", "annotated_quote")}
SELECT {_COMBINED_SHOWN} FROM combined WHERE ask_size IS NOT NULL""",
    "fill_latest_eod": f"""WITH {_TABLES}, {_combined("symbol", "annotated_quote")}, {_LAST_OF_DAY}
SELECT {_FILLED_SHOWN}, CAST(l.latest_trade_pr AS DOUBLE) AS latest_trade_pr,
       l.mov_avg_pr AS mov_avg_pr
FROM (SELECT * EXCLUDE (trade_pr, mov_avg_pr) FROM combined)
JOIN last_of_day l USING (trade_dt, symbol, exchange)""",
    "fill_asof": f"""WITH {_TABLES},
averaged AS (
  SELECT *, {_average("trade_dt, symbol", "30 MINUTES")} AS mov_avg_pr FROM latest_trade),
filled AS (
  SELECT q.*, t.trade_pr AS latest_trade_pr, t.mov_avg_pr
  FROM annotated_quote q ASOF LEFT JOIN averaged t
    ON q.trade_dt = t.trade_dt AND q.symbol = t.symbol AND q.exchange = t.exchange
   AND q.event_tm >= t.event_tm)
SELECT {_QUOTE_SHOWN}, {_LATEST}, CAST(latest_trade_pr AS DOUBLE) AS latest_trade_pr, mov_avg_pr
FROM filled""",
    "join_close_broadcast": f"""WITH {_TABLES}, {_CLOSES.format(trades="trade")}
SELECT {_QUOTE_SHOWN}, CAST(close_pr AS DOUBLE) AS close_pr
FROM quote LEFT JOIN close_of USING (trade_dt, symbol, exchange)""",
    "run_log_job_ids": f"WITH {_LOG} SELECT job_id, count(*) AS n_rows FROM log GROUP BY job_id",
    "run_log_latest": f"""WITH {_LOG}
SELECT job_id, arg_max(status, ts) AS status FROM log GROUP BY job_id""",
    "enriched_quotes": _enriched(_EARLIER_DAY),
    "enriched_quotes_with_bid": _enriched(_DAY_BEFORE, bid=True),
    "enriched_quotes_eod": f"""WITH {_TABLES}, {_combined("trade_dt, symbol", "latest_quote")},
{_LAST_OF_DAY}, {_CLOSES.format(trades="latest_trade")}
SELECT {_FILLED_SHOWN}, CAST(l.latest_trade_pr AS DOUBLE) AS latest_trade_pr,
       l.mov_avg_pr AS mov_avg_pr, CAST(close_pr AS DOUBLE) AS close_pr
FROM (SELECT * EXCLUDE (trade_pr, mov_avg_pr) FROM combined WHERE ask_size IS NOT NULL)
JOIN last_of_day l USING (trade_dt, symbol, exchange)
LEFT JOIN close_of USING (trade_dt, symbol, exchange)""",
}
ORACLE["daily_trades"] = ORACLE["load_trades"]
ORACLE["daily_quotes"] = ORACLE["load_quotes"]
ORACLE["daily_enriched"] = _enriched(_EARLIER_DAY, tables=_DAILY_TABLES)
# Which dates a late folder with the corrections of even days changes: those of its proper messages.
_LATE = """late AS (
  SELECT DISTINCT trade_dt FROM messages WHERE partition <> 'B'
  AND day(CAST(trade_dt AS DATE)) % 2 = 0
  AND CAST(arrival_tm AS TIMESTAMP) = CAST(event_tm AS TIMESTAMP) + INTERVAL '6' SECOND)"""
ORACLE["late_corrections"] = f"""WITH {_RAW}, messages AS ({_ALL}), {_LATE},
typed AS (SELECT {_TRADE_TYPED} FROM messages WHERE {_TRADE_PROPER})
SELECT *, arrival_tm AS latest, trade_dt IN (SELECT trade_dt FROM late) AS rebuilt
FROM typed {_NEWEST}"""
ORACLE["enriched_without_first_trades"] = _enriched(
    _EARLIER_DAY,
    tables=_DAILY_TABLES.replace(
        f"FROM messages WHERE {_TRADE_PROPER}",
        f"FROM messages WHERE {_TRADE_PROPER} AND trade_dt > (SELECT min(CAST(trade_dt AS VARCHAR)) FROM base)",
    ),
)

_OFFSET = """CASE event_seq_nb % 4 WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' WHEN 2 THEN '-08:00' ELSE '' END"""
ORACLE["zoned_times"] = f"""WITH {_TABLES},
texts AS (SELECT *, concat(CAST(event_tm AS VARCHAR), {_OFFSET}) AS text FROM trade)
SELECT event_seq_nb, CAST(arrival_tm AS VARCHAR) AS arrival_tm, text,
       CAST(CASE WHEN event_seq_nb % 4 = 3 THEN event_tm
            ELSE timezone('America/New_York', CAST(text AS TIMESTAMPTZ)) END AS VARCHAR) AS local_tm
FROM texts"""
ORACLE["carried_month_ends"] = f"""WITH {_TABLES}, {_CLOSES.format(trades="latest_trade")},
bounds AS (SELECT date_trunc('month', min(trade_dt))::DATE AS first, max(trade_dt) AS last_day FROM close_of),
spread AS (
  SELECT (first + to_months(2 * (trade_dt - first)::INT))::DATE AS trade_dt, symbol, exchange, close_pr
  FROM close_of, bounds WHERE close_pr IS NOT NULL),
months AS (
  SELECT unnest(range(first::TIMESTAMP, (first + to_months(2 * (last_day - first)::INT + 1)), INTERVAL '1' MONTH))::DATE AS month
  FROM bounds)
SELECT CAST(m.month AS VARCHAR) AS month, CAST(s.trade_dt AS VARCHAR) AS trade_dt, k.symbol, k.exchange,
       CAST(s.close_pr AS DOUBLE) AS close_pr
FROM months m CROSS JOIN (SELECT DISTINCT symbol, exchange FROM spread) k
ASOF JOIN spread s
  ON s.symbol = k.symbol AND s.exchange = k.exchange AND (m.month + INTERVAL '1' MONTH)::DATE > s.trade_dt"""
ORACLE["run_log_runs"] = f"""WITH {_LOG.replace("AS status", "AS status, event_id")}
SELECT concat(job_id, '-', event_id % 7) AS run_id, arg_max(status, (ts, event_id::VARCHAR)) AS status
FROM log GROUP BY 1"""
