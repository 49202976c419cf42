"""The registered queries: each operator and job over the whole events table."""

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sample_market as market
from tapeline.functions.casts import event_time
from tapeline.operators.asof import fill_asof, trade_points
from tapeline.operators.corrections import (
    annotate_latest,
    keep_latest,
    quote_rows,
    rejected_rows,
    trade_rows,
)
from tapeline.operators.enrichment import combine, fill_latest_eod, filter_quotes, join_close
from tapeline.operators.moving_average import moving_average
from tapeline.operators.parsing import (
    all_events,
    bad_records,
    parse_csv,
    parse_json,
    to_events,
)
from tapeline.operators.prices import (
    carried_closes,
    last_event_time,
    last_price,
    last_price_literal,
    prev_close,
)
from tapeline.plans.jobs import (
    enrich_quotes,
    enrich_quotes_eod,
    ingest,
    load_quotes,
    load_trades,
    run_enrich,
    run_ingest,
    run_load,
)
from tapeline.plans.runlog import FAILED, RunLog, job_id, latest_status
from tapeline.schemas import ENRICHED_COLUMNS, QUOTE, QUOTE_TYPES, TRADE, TRADE_TYPES
from tapeline.sources.messages import format_glob, source_files
from tapeline.sources.staging import stage, staging_path
from tapeline.sources.tables import among, on_dates, read_events, write_partitioned
from tapeline.sources.versions import read_table, spreading

Query = Callable[[SparkSession, str], DataFrame]

REPORT_DATE = "2024-01-15"
LATE_FOLDER = "DATE '2030-01-01'"


def portable(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, dates and times as text: the same in both engines."""
    shown = []
    for name, kind in rows.dtypes:
        if kind.startswith("decimal"):
            shown.append(F.col(name).cast("double").alias(name))
        elif kind in ("date", "timestamp", "timestamp_ntz"):
            shown.append(F.col(name).cast("string").alias(name))
        else:
            shown.append(F.col(name))
    return rows.select(*shown)


def _trades(spark, sf_dir):
    return keep_latest(market.raw_trades(spark, sf_dir))


def _quotes(spark, sf_dir):
    return keep_latest(market.raw_quotes(spark, sf_dir))


def _stored(spark, sf_dir):
    """Latest trades and quotes as stored tables, as the load job leaves them."""
    return stage(_trades(spark, sf_dir), "trade"), stage(_quotes(spark, sf_dir), "quote")


def _message_files(spark, sf_dir, messages=None, src_date="trade_dt") -> str:
    """Message files of both formats in the shared folder, by date and exchange."""
    root = staging_path(spark, "messages")
    messages = market.raw_messages(spark, sf_dir) if messages is None else messages
    origin = ["src_date", "src_exchange"]
    for name, exchange, lines_of in (
        ("csv", "NYSE", market.csv_lines),
        ("json", "NASDAQ", market.json_lines),
    ):
        lines = lines_of(
            messages.where(F.col("exchange") == exchange)
            .withColumns({"src_date": F.expr(src_date), "src_exchange": F.col("exchange")}),
            *origin,
        )
        with spreading(spark):
            lines.hint("rebalance", *origin).write.partitionBy(*origin).text(f"{root}/{name}")
    return root


def _event_table(spark, sf_dir) -> str:
    """The event table as the ingest job writes it from those files."""
    root = _message_files(spark, sf_dir)
    path = staging_path(spark, "events")
    events = ingest(spark, format_glob(root, "csv"), format_glob(root, "json"))
    write_partitioned(events, path, ["src_date", "partition"])
    return path


def _daily_tables(spark, sf_dir):
    """The stored tables, by the jobs: a format at a time, and one date once more."""
    root, path = _message_files(spark, sf_dir), staging_path(spark, "daily")
    events, log = f"{path}/events", f"{path}/log"
    run_ingest(spark, format_glob(root, "csv"), None, events, log)
    run_ingest(spark, None, format_glob(root, "json"), events, log)
    run_load(spark, events, f"{path}/tables", log)
    run_load(spark, events, f"{path}/tables", log, REPORT_DATE)
    return path


def daily_trades(spark, sf_dir):
    return read_table(spark, f"{_daily_tables(spark, sf_dir)}/tables/trade")


def daily_quotes(spark, sf_dir):
    return read_table(spark, f"{_daily_tables(spark, sf_dir)}/tables/quote")


def daily_enriched(spark, sf_dir):
    path = _daily_tables(spark, sf_dir)
    tables, output, log = f"{path}/tables", f"{path}/enriched", f"{path}/log"
    run_enrich(spark, tables, output, log)
    run_enrich(spark, tables, output, log, REPORT_DATE)
    return read_table(spark, output).select(*ENRICHED_COLUMNS)


def late_corrections(spark, sf_dir):
    """The trades after corrections of every even day came in one late folder.

    The second load is told no dates; ``rebuilt`` marks those it chose.
    """
    path = staging_path(spark, "late")
    events, tables, log = f"{path}/events", f"{path}/tables", f"{path}/log"
    corrected = F.expr("arrival_tm = event_tm + INTERVAL '6' SECOND")
    late = corrected & (F.day("trade_dt") % 2 == 0)
    messages = market.raw_messages(spark, sf_dir)
    for part, src_date in ((messages.where(~late), "trade_dt"), (messages.where(late), LATE_FOLDER)):
        root = _message_files(spark, sf_dir, part, src_date)
        # corrected events have even numbers, so all are of the exchange that sends CSV
        json = None if src_date == LATE_FOLDER else format_glob(root, "json")
        run_ingest(spark, format_glob(root, "csv"), json, events, log)
        dates = run_load(spark, events, tables, log)
    return read_table(spark, f"{tables}/trade").withColumn("rebuilt", among("trade_dt", dates))


def enriched_without_first_trades(spark, sf_dir):
    """Enriched quotes of a store whose first date has quotes only, and is enriched first."""
    path = staging_path(spark, "sparse")
    events, tables, output, log = (f"{path}/{name}" for name in ("events", "tables", "enriched", "log"))
    messages = market.raw_messages(spark, sf_dir)
    first = messages.agg(F.min("trade_dt")).first()[0]
    is_first = F.col("trade_dt") == F.lit(first)
    for part in (messages.where(is_first & (F.col("rec_type") != TRADE)), messages.where(~is_first)):
        root = _message_files(spark, sf_dir, part)
        run_ingest(spark, format_glob(root, "csv"), format_glob(root, "json"), events, log)
        dates = run_load(spark, events, tables, log)
        run_enrich(spark, tables, output, log, [day for day in dates if day])
    return read_table(spark, output).select(*ENRICHED_COLUMNS)


def ingest_csv(spark, sf_dir):
    return to_events(parse_csv(market.csv_lines(market.raw_messages(spark, sf_dir))))


def ingest_json(spark, sf_dir):
    return to_events(parse_json(market.json_lines(market.raw_messages(spark, sf_dir))))


def ingest_all(spark, sf_dir):
    return all_events(*market.split_lines(spark, sf_dir))


def bad_lines(spark, sf_dir):
    return bad_records(*market.split_lines(spark, sf_dir))


def files_by_origin(spark, sf_dir):
    root = _message_files(spark, sf_dir)
    files = source_files(spark, root, "csv").unionByName(source_files(spark, root, "json"))
    return files.groupBy("src_format", "src_date", "src_exchange").agg(
        F.sum("n_lines").alias("n_lines")
    )


def partition_counts(spark, sf_dir):
    events = spark.read.parquet(_event_table(spark, sf_dir))
    return events.groupBy("src_date", "partition").agg(F.count("*").alias("n_events"))


def read_trades(spark, sf_dir):
    return trade_rows(read_events(spark, _event_table(spark, sf_dir), TRADE))


def read_quotes(spark, sf_dir):
    return quote_rows(read_events(spark, _event_table(spark, sf_dir), QUOTE))


def rejected_trades(spark, sf_dir):
    events = ingest_all(spark, sf_dir)
    return rejected_rows(events.where(F.col("partition") == TRADE), TRADE_TYPES)


def rejected_quotes(spark, sf_dir):
    events = ingest_all(spark, sf_dir)
    return rejected_rows(events.where(F.col("partition") == QUOTE), QUOTE_TYPES)


def loaded_trades(spark, sf_dir):
    return load_trades(ingest_all(spark, sf_dir))


def loaded_quotes(spark, sf_dir):
    return load_quotes(ingest_all(spark, sf_dir))


def trades_on_date(spark, sf_dir):
    return on_dates(market.raw_trades(spark, sf_dir), REPORT_DATE)


def annotated_trades(spark, sf_dir):
    return annotate_latest(market.raw_trades(spark, sf_dir))


def annotated_quotes(spark, sf_dir):
    return annotate_latest(market.raw_quotes(spark, sf_dir))


def _average(trades):
    return trades.select(
        "trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb", "trade_pr", "mov_avg_pr"
    )


def moving_avg_30m(spark, sf_dir):
    return _average(moving_average(stage(_trades(spark, sf_dir), "trade")))


def moving_avg_6h(spark, sf_dir):
    return _average(moving_average(stage(_trades(spark, sf_dir), "trade"), 6 * 3600))


def moving_avg_bucketed(spark, sf_dir):
    """One average per symbol and exchange, over cells of five minutes."""
    trades = stage(_trades(spark, sf_dir), "trade")
    return _average(moving_average(trades, 6 * 3600, ("symbol", "exchange"), cell_seconds=300))


def zoned_times(spark, sf_dir):
    """Event times written with and without offsets, shown in one time zone."""
    seq = F.col("event_seq_nb")
    text = F.concat(
        F.col("event_tm").cast("string"),
        F.when(seq % 4 == 0, "Z").when(seq % 4 == 1, "+05:30").when(seq % 4 == 2, "-08:00").otherwise(""),
    )
    rows = market.raw_trades(spark, sf_dir).withColumn("text", text)
    local = event_time(F.col("text"), F.lit("2024-01-01"), "America/New_York")
    return rows.select("event_seq_nb", "arrival_tm", "text", local.alias("local_tm"))


def carried_month_ends(spark, sf_dir):
    """Closes at month ends: of all at once up to the tenth day, then carried on from there."""
    closes = stage(last_price(_trades(spark, sf_dir), one_version=True), "close")
    days = closes.agg(F.min("trade_dt"), F.max("trade_dt")).first()
    first = days[0].replace(day=1)
    # each day stands for one two months long, so that there are month ends between
    spread = F.add_months(F.lit(first), 2 * F.datediff("trade_dt", F.lit(first)))
    closes = stage(closes.withColumn("trade_dt", spread), "spread")
    middle, last = spark.range(1).select(
        F.add_months(F.lit(first), 20), F.add_months(F.lit(first), 2 * (days[1] - first).days)
    ).first()
    early = closes.where(F.col("trade_dt") < F.lit(middle))
    carried = stage(carried_closes(early, early.limit(0), None, middle - timedelta(days=1)), "carried")
    before = carried.where(F.col("month") == F.add_months(F.lit(middle), -1))
    later = carried_closes(closes.where(F.col("trade_dt") >= F.lit(middle)), before, middle, last)
    return carried.unionByName(later.where(F.col("month") >= F.lit(middle)))


def last_event_times(spark, sf_dir):
    return last_event_time(market.raw_trades(spark, sf_dir))


def closing_prices(spark, sf_dir):
    return last_price(_trades(spark, sf_dir), one_version=True)


def closing_prices_literal(spark, sf_dir):
    return last_price_literal(_trades(spark, sf_dir))


def previous_closes(spark, sf_dir):
    closes = last_price(market.raw_trades(spark, sf_dir))
    return prev_close(closes, market.raw_quotes(spark, sf_dir))


def previous_closes_calendar_day(spark, sf_dir):
    closes = last_price(market.raw_trades(spark, sf_dir))
    return prev_close(closes, market.raw_quotes(spark, sf_dir), calendar_day=True)


def _combined(spark, sf_dir, include_bid_pr=False):
    trades = moving_average(stage(_trades(spark, sf_dir), "trade"))
    return combine(trades, annotated_quotes(spark, sf_dir), include_bid_pr)


def combined_with_bid(spark, sf_dir):
    return _combined(spark, sf_dir, include_bid_pr=True)


def quotes_of_combined(spark, sf_dir):
    return filter_quotes(_combined(spark, sf_dir))


def filled_latest_eod(spark, sf_dir):
    return fill_latest_eod(stage(_combined(spark, sf_dir), "combined"), one_version=True)


def filled_asof(spark, sf_dir):
    points = trade_points(stage(_trades(spark, sf_dir), "trade"))
    filled = fill_asof(stage(annotated_quotes(spark, sf_dir), "quote"), points)
    return filled.withColumnRenamed("trade_pr", "latest_trade_pr")


def quotes_with_close(spark, sf_dir):
    closes = stage(last_price(market.raw_trades(spark, sf_dir)), "close")
    return join_close(market.raw_quotes(spark, sf_dir), closes)


def _run_log(spark, sf_dir):
    """Status changes of four jobs, one for each event."""
    kind = F.col("event_type")
    status = (
        F.when(kind == "error", "failed")
        .when(kind == "purchase", "success")
        .when(kind == "click", "running")
        .otherwise("starting")
    )
    job_name = F.concat(F.lit("job"), (F.col("user_id") % 4).cast("string"))
    return (
        market.events(spark, sf_dir)
        .select(
            job_name.alias("job_name"),
            F.col("event_id").cast("string").alias("row_key"),
            F.col("ts").cast("timestamp").alias("ts"),
            status.alias("status"),
            F.when(kind == "error", F.col("props")).alias("error"),
        )
        .withColumn("job_id", job_id(F.col("job_name"), F.col("ts")))
    )


def run_log_job_ids(spark, sf_dir):
    return _run_log(spark, sf_dir).groupBy("job_id").agg(F.count("*").alias("n_rows"))


def run_log_latest(spark, sf_dir):
    """From a stored log, appended to twice."""
    log, changes = RunLog(spark, staging_path(spark, "log")), _run_log(spark, sf_dir)
    failed = F.col("status") == FAILED
    log.append(changes.where(failed))
    log.append(changes.where(~failed))
    return latest_status(log.rows())


def run_log_runs(spark, sf_dir):
    """Last status of each run, from a stored log whose days were compacted between appends.

    Events of one remainder by seven stand for one of a job's runs of a day.
    """
    log = RunLog(spark, staging_path(spark, "log"))
    run_id = F.concat_ws("-", "job_id", F.col("row_key").cast("bigint") % 7)
    changes = _run_log(spark, sf_dir).withColumn("run_id", run_id)
    failed = F.col("status") == FAILED
    log.append(changes.where(failed))
    log.append(changes.where(~failed))
    log.compact(date(2024, 1, 20))
    return latest_status(log.rows(), "run_id")


def enriched_quotes(spark, sf_dir):
    return enrich_quotes(*_stored(spark, sf_dir))


def enriched_quotes_with_bid(spark, sf_dir):
    return enrich_quotes(*_stored(spark, sf_dir), calendar_day=True, include_bid_pr=True)


def enriched_quotes_eod(spark, sf_dir):
    return enrich_quotes_eod(*_stored(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "ingest_csv": ingest_csv,
    "ingest_json": ingest_json,
    "ingest_all": ingest_all,
    "bad_records": bad_lines,
    "source_files": files_by_origin,
    "partition_counts": partition_counts,
    "read_trades": read_trades,
    "read_quotes": read_quotes,
    "rejected_trades": rejected_trades,
    "rejected_quotes": rejected_quotes,
    "load_trades": loaded_trades,
    "load_quotes": loaded_quotes,
    "trades_on_date": trades_on_date,
    "annotate_latest": annotated_trades,
    "annotate_latest_quotes": annotated_quotes,
    "keep_latest": _trades,
    "keep_latest_quotes": _quotes,
    "moving_avg_30m": moving_avg_30m,
    "moving_avg_6h": moving_avg_6h,
    "moving_avg_bucketed": moving_avg_bucketed,
    "zoned_times": zoned_times,
    "carried_month_ends": carried_month_ends,
    "last_event_time": last_event_times,
    "last_price": closing_prices,
    "last_price_literal": closing_prices_literal,
    "prev_close": previous_closes,
    "prev_close_calendar_day": previous_closes_calendar_day,
    "combine": _combined,
    "combine_with_bid": combined_with_bid,
    "filter_quotes": quotes_of_combined,
    "fill_latest_eod": filled_latest_eod,
    "fill_asof": filled_asof,
    "join_close_broadcast": quotes_with_close,
    "run_log_job_ids": run_log_job_ids,
    "run_log_latest": run_log_latest,
    "run_log_runs": run_log_runs,
    "enriched_quotes": enriched_quotes,
    "enriched_quotes_with_bid": enriched_quotes_with_bid,
    "enriched_quotes_eod": enriched_quotes_eod,
    "daily_trades": daily_trades,
    "daily_quotes": daily_quotes,
    "daily_enriched": daily_enriched,
    "late_corrections": late_corrections,
    "enriched_without_first_trades": enriched_without_first_trades,
}


def registered() -> dict[str, Query]:
    def shown(query: Query) -> Query:
        return lambda spark, sf_dir: portable(query(spark, sf_dir))

    return {name: shown(query) for name, query in QUERIES.items()}
