"""Message lines to the common event table.

A line that is no complete trade or quote message becomes a row of record type
``B`` with every other field NULL; its text stays in ``raw_line`` until
:func:`to_events` drops it, so :func:`bad_records` can still show it.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeline.schemas import BAD, COMMON_COLUMNS, QUOTE, TRADE

# Fixed message layouts: where each event column stands in a CSV message, and
# under which name in a JSON message.  A trade's size goes to bid_size.
_CSV_TYPE_FIELD = 2
_CSV_EVENT = {
    "trade_dt": 0,
    "arrival_tm": 1,
    "rec_type": 2,
    "symbol": 3,
    "event_tm": 4,
    "event_seq_nb": 5,
    "exchange": 6,
}
_CSV_FIELDS = {
    TRADE: {**_CSV_EVENT, "trade_pr": 7, "bid_size": 8},
    QUOTE: {**_CSV_EVENT, "bid_pr": 7, "bid_size": 8, "ask_pr": 9, "ask_size": 10},
}
_JSON_EVENT = {
    "trade_dt": "trade_dt",
    "rec_type": "event_type",
    "symbol": "symbol",
    "exchange": "exchange",
    "event_tm": "event_tm",
    "event_seq_nb": "event_seq_nb",
    "arrival_tm": "file_tm",
}
_JSON_FIELDS = {
    TRADE: {**_JSON_EVENT, "trade_pr": "price", "bid_size": "size"},
    QUOTE: {
        **_JSON_EVENT,
        "bid_pr": "bid_pr",
        "bid_size": "bid_size",
        "ask_pr": "ask_pr",
        "ask_size": "ask_size",
    },
}
_END = "__end_of_line"
# A JSON trade must name its execution, though the value is not kept.
_JSON_ALSO_NEEDED = {TRADE: ["execution_id"], QUOTE: []}


def _common_event(lines: DataFrame, kind: Column, fields: dict, value_of) -> DataFrame:
    """Add the common columns, given each row's ``kind`` (T, Q or B).

    The event leaves as the single element of an inlined array.  Catalyst would
    copy the whole parse into every filter on a parsed column; it does not move
    filters below a generator.
    """

    def column(name: str) -> Column:
        chosen = F.lit(None).cast("string")
        for record_type, layout in fields.items():
            if name in layout:
                chosen = F.when(
                    F.col("__kind") == record_type, value_of(layout[name])
                ).otherwise(chosen)
        return chosen.alias(name)

    kept = [c for c in lines.columns if not c.startswith("__")]
    event = F.struct(
        *[column(name) for name in COMMON_COLUMNS if name != "partition"],
        F.col("__kind").alias("partition"),
    )
    return lines.withColumn("__kind", kind).select(*kept, F.inline(F.array(event)))


def parse_csv(lines: DataFrame) -> DataFrame:
    """CSV messages in ``raw_line`` to common events.

    Fields are split at every comma, without quoting or trimming.  Fields past
    the layout's last one are ignored.
    """
    fields = F.col("__fields")
    record_type = F.get(fields, F.lit(_CSV_TYPE_FIELD))
    kind = F.lit(BAD)
    for name, layout in _CSV_FIELDS.items():
        complete = F.size(fields) > max(layout.values())
        kind = F.when((record_type == name) & complete, F.lit(name)).otherwise(kind)
    return _common_event(
        lines.withColumn("__fields", F.split("raw_line", ",", -1)),
        kind,
        _CSV_FIELDS,
        lambda position: F.get(fields, F.lit(position)),
    )


def parse_json(lines: DataFrame) -> DataFrame:
    """JSON messages in ``raw_line`` to common events.

    A needed name that is missing makes the line bad; a name with the value
    ``null`` does not.  A name that occurs twice counts with its last value.
    The line is parsed as a member of an object that ends with a mark, so that text
    after the message makes it bad rather than being passed over.  A line that holds
    the mark itself could feign that end; it is parsed as the only element of an
    array instead, whose early end it cannot give as well.  Numbers are JSON's:
    ``NaN`` is none.
    """
    needed = {
        name: [*layout.values(), *_JSON_ALSO_NEEDED[name]]
        for name, layout in _JSON_FIELDS.items()
    }
    names = sorted({field for fields in needed.values() for field in fields})
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    fields_type = "struct<" + ",".join(f"{name}:string" for name in names) + ">"
    line = F.col("raw_line")
    marked = F.from_json(
        F.concat(F.lit('{"m":'), line, F.lit(f',"{_END}":"1"}}')),
        f"struct<m:{fields_type},{_END}:string>",
        options,
    )
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), f"array<{fields_type}>", options)
    holds_mark = F.contains(line, F.lit(_END))
    message = F.col("__message")
    kind = F.lit(BAD)
    for name, fields in needed.items():
        all_set = reduce(and_, [message[field].isNotNull() for field in fields])
        # only a line with a NULL is looked at again, for the names it holds
        missing = F.array_except(
            F.array(*[F.lit(field) for field in fields]), F.json_object_keys("raw_line")
        )
        complete = all_set | (F.size(missing) == 0)
        kind = F.when((message["event_type"] == name) & complete, F.lit(name)).otherwise(kind)
    return _common_event(
        lines.withColumns(
            {"__marked": F.when(~holds_mark, marked), "__listed": F.when(holds_mark, listed)}
        ).withColumn(
            "__message",
            F.when(F.col("__marked")[_END] == "1", F.col("__marked")["m"]).when(
                F.size("__listed") == 1, F.get("__listed", F.lit(0))
            ),
        ),
        kind,
        _JSON_FIELDS,
        lambda name: message[name],
    )


def to_events(parsed: DataFrame, *extra: str) -> DataFrame:
    """The common event columns (P3), after any ``extra`` columns to keep."""
    return parsed.select(*extra, *COMMON_COLUMNS)


def all_events(csv_lines: DataFrame, json_lines: DataFrame, *extra: str) -> DataFrame:
    """Events of both message formats in one table (P5)."""
    return to_events(parse_csv(csv_lines), *extra).unionByName(
        to_events(parse_json(json_lines), *extra)
    )


def bad_records(csv_lines: DataFrame, json_lines: DataFrame, *extra: str) -> DataFrame:
    """Text of the lines that went to partition ``B``, with their format."""

    def bad(parsed: DataFrame, source: str) -> DataFrame:
        return parsed.where(F.col("partition") == BAD).select(
            *extra, F.lit(source).alias("source"), "raw_line"
        )

    return bad(parse_csv(csv_lines), "csv").unionByName(bad(parse_json(json_lines), "json"))
