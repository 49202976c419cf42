import json

import pytest
from pyspark.sql import functions as F

from tapeline.functions import casts
from tapeline.operators.parsing import all_events, bad_records, parse_csv, parse_json, to_events
from tapeline.schemas import COMMON_COLUMNS, COMMON_SCHEMA

T_LINE = "2020-08-05,2020-08-05 09:00:01,T,A,2020-08-05 09:00:00,1,N,10.0,5"
Q_LINE = "2020-08-05,2020-08-05 09:00:01,Q,A,2020-08-05 09:00:00,2,N,9.9,5,10.1,6"
EVENT = {
    "trade_dt": "2020-08-05",
    "symbol": "A",
    "exchange": "N",
    "event_tm": "2020-08-05 09:00:00",
    "event_seq_nb": 1,
    "file_tm": "2020-08-05 09:00:01",
}
T_JSON = {**EVENT, "event_type": "T", "execution_id": "x", "price": 78.930, "size": 5}
Q_JSON = {**EVENT, "event_type": "Q", "bid_pr": 9.9, "bid_size": 5, "ask_pr": 10.1, "ask_size": 6}


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "raw_line string")


def parsed(parse, spark, texts):
    rows = parse(lines(spark, texts)).collect()
    return {row["raw_line"]: row for row in rows}


def without(message, *names):
    return {k: v for k, v in message.items() if k not in names}


def test_complete_csv_messages(spark):
    found = parsed(parse_csv, spark, [T_LINE, Q_LINE, T_LINE + ",extra"])
    trade, quote = found[T_LINE], found[Q_LINE]
    assert [trade[c] for c in COMMON_COLUMNS] == [
        "2020-08-05", "T", "A", "N", "2020-08-05 09:00:00", "1", "2020-08-05 09:00:01",
        "10.0", None, "5", None, None, "T",
    ]
    assert [quote[c] for c in COMMON_COLUMNS[6:]] == [
        "2020-08-05 09:00:01", None, "9.9", "5", "10.1", "6", "Q",
    ]
    assert found[T_LINE + ",extra"]["partition"] == "T"


@pytest.mark.parametrize(
    "line",
    [
        Q_LINE.rsplit(",", 1)[0],
        T_LINE.rsplit(",", 1)[0],
        "a,b,X,c,d,e,f,g,h,i,j",
        "a,b,t,c,d,e,f,g,h",
        "a,b, T,c,d,e,f,g,h",
        "",
        "x",
        "a,b",
    ],
)
def test_incomplete_csv_messages_are_bad(spark, line):
    row = parsed(parse_csv, spark, [line])[line]
    assert row["partition"] == "B"
    assert all(row[c] is None for c in COMMON_COLUMNS[:-1])


def test_empty_csv_fields_stay_empty_text(spark):
    line = "2020-08-05,,T,A,,,N,,"
    row = parsed(parse_csv, spark, [line])[line]
    assert (row["partition"], row["event_tm"], row["bid_size"]) == ("T", "", "")


def test_complete_json_messages(spark):
    trade_line, quote_line = json.dumps(T_JSON), json.dumps(Q_JSON)
    found = parsed(parse_json, spark, [trade_line, quote_line])
    assert [found[trade_line][c] for c in COMMON_COLUMNS] == [
        "2020-08-05", "T", "A", "N", "2020-08-05 09:00:00", "1", "2020-08-05 09:00:01",
        "78.93", None, "5", None, None, "T",
    ]
    assert [found[quote_line][c] for c in COMMON_COLUMNS[6:]] == [
        "2020-08-05 09:00:01", None, "9.9", "5", "10.1", "6", "Q",
    ]


def test_json_nulls_are_valid_and_missing_names_are_not(spark):
    null_bid = json.dumps({**Q_JSON, "bid_pr": None})
    null_execution = json.dumps({**T_JSON, "execution_id": None})
    found = parsed(parse_json, spark, [null_bid, null_execution])
    assert (found[null_bid]["partition"], found[null_bid]["bid_pr"]) == ("Q", None)
    assert found[null_execution]["partition"] == "T"
    for message, needed in ((T_JSON, list(T_JSON)), (Q_JSON, list(Q_JSON))):
        short = [json.dumps(without(message, name)) for name in needed]
        assert {row["partition"] for row in parsed(parse_json, spark, short).values()} == {"B"}


@pytest.mark.parametrize(
    "line",
    [
        '{"event_type":"Z"}',
        json.dumps({**T_JSON, "event_type": "Z"}),
        "{oops",
        "[1]",
        "",
        "null",
        json.dumps(T_JSON) + " junk",
        json.dumps(T_JSON) + "," + json.dumps(T_JSON),
        json.dumps(T_JSON).replace('"', "'"),
        json.dumps(T_JSON)[:-5],
    ],
)
def test_other_json_lines_are_bad(spark, line):
    row = parsed(parse_json, spark, [line])[line]
    assert row["partition"] == "B"
    assert all(row[c] is None for c in COMMON_COLUMNS[:-1])


def test_repeated_json_name_counts_with_its_last_value(spark):
    line = json.dumps(T_JSON)[:-1] + ',"price":2}'
    assert parsed(parse_json, spark, [line])[line]["trade_pr"] == "2"


def test_json_numbers_and_nested_values(spark):
    big = json.dumps({**T_JSON, "price": 10000000.0, "size": {"x": 1}})
    row = parsed(parse_json, spark, [big])[big]
    assert (row["trade_pr"], row["bid_size"]) == ("1.0E7", '{"x":1}')


def test_both_formats_and_every_line_kept(spark):
    csv, json_ = [T_LINE, Q_LINE, "", "x"], [json.dumps(T_JSON), "{oops"]
    events = all_events(lines(spark, csv), lines(spark, json_))
    assert events.schema == COMMON_SCHEMA or [f.name for f in events.schema] == list(COMMON_COLUMNS)
    counts = dict(events.groupBy("partition").count().collect())
    assert counts == {"T": 2, "Q": 1, "B": 3}
    bad = bad_records(lines(spark, csv), lines(spark, json_)).collect()
    assert sorted(map(tuple, bad)) == [("csv", ""), ("csv", "x"), ("json", "{oops")]


def test_filter_on_a_parsed_column_does_not_repeat_the_parse(spark):
    events = to_events(parse_json(lines(spark, ["{}"]))).where("partition = 'T' AND symbol = 'A'")
    plan = events._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 2  # the usual form, and that for lines with the mark


def test_text_after_a_json_message_makes_the_line_bad(spark):
    good = (
        '{"trade_dt":"2020-08-05","event_type":"T","symbol":"A","exchange":"N","event_tm":"x",'
        '"event_seq_nb":1,"file_tm":"y","execution_id":"e","price":1.5,"size":2}'
    )
    bad = [f"{good}{end}" for end in ("]", "] junk", "] junk}", f"] {good}", "} junk", f",{good}", "x")]
    bad += [good[:-1], "", "null", "[1]", good.replace("1.5", "NaN"), f'{good},"__end_of_line":"1"}}']
    bad += [f'{good},"__end_of_line":"1","x":{{']
    fine = [good, f"  {good} ", good.replace('"x"', '"__end_of_line"')]
    rows = spark.createDataFrame([(line,) for line in [*fine, *bad]], "raw_line string")
    found = {r.raw_line: r.partition for r in parse_json(rows).collect()}
    assert {line: found[line] for line in bad} == dict.fromkeys(bad, "B")
    assert {line: found[line] for line in fine} == dict.fromkeys(fine, "T")


@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_times_with_a_zone(spark, settings, session_zone):
    settings({"spark.sql.session.timeZone": session_zone})
    texts = {
        "2020-08-05 09:00:00Z": "2020-08-05 05:00:00",
        "2020-08-05T09:00:00.123456+05:30": "2020-08-04 23:30:00.123456",
        "2020-01-05 09:00:00 Europe/Paris": "2020-01-05 03:00:00",
        "09:00:00-08:00": "2020-08-05 13:00:00",  # on the trade date, there
        # clocks go back at 06:00 UTC: two instants an hour apart have the same local time
        "2020-11-01 05:30:00Z": "2020-11-01 01:30:00",
        "2020-11-01 06:30:00Z": "2020-11-01 01:30:00",
        # clocks go forward at 07:00 UTC
        "2020-03-08 06:59:59Z": "2020-03-08 01:59:59",
        "2020-03-08 07:00:00Z": "2020-03-08 03:00:00",
        # without a zone: as written, in the hour left out too
        "2020-03-08 02:30:00": "2020-03-08 02:30:00",
        "2020-08-05 09:00:00": "2020-08-05 09:00:00",
        "09:00:00": "2020-08-05 09:00:00",
        "2020-08-05 09:00:00+99:00": None,
        "2020-08-05 09:00:00 Nowhere/City": None,
        "1890-01-01 12:00:00Z": "1890-01-01 07:00:00",
        "junk": None,
    }
    frame = spark.createDataFrame([(t, "2020-08-05") for t in texts], "text string, day string")
    local = casts.event_time(F.col("text"), F.col("day"), "America/New_York")
    found = {r.text: r.t and str(r.t) for r in frame.select("text", local.alias("t")).collect()}
    assert found == texts
    without = {r.text: r.t for r in frame.select("text", casts.event_time(F.col("text"), F.col("day")).alias("t")).collect()}
    assert [t for t, time in without.items() if time is not None] == [
        "2020-03-08 02:30:00", "2020-08-05 09:00:00", "09:00:00",
    ]
