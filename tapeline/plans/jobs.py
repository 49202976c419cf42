"""The three daily jobs (E1-E4): ingest messages, load tables, enrich quotes.

The ``ingest`` and ``load_*`` functions are lazy; the ``enrich_*`` functions stage
what they read several times, so they run jobs.  The ``run_*`` functions read and
write the stored tables and log their status.
"""

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.operators.asof import fill_asof, trade_points
from tapeline.operators.corrections import (
    keep_latest,
    quote_rows,
    rejected_rows,
    trade_rows,
    typed_rows,
)
from tapeline.operators.enrichment import REC_TYPE, combine, fill_latest_eod, join_close
from tapeline.operators.moving_average import moving_average
from tapeline.operators.parsing import all_events, bad_records
from tapeline.operators.prices import carried_closes, last_price, prev_close
from tapeline.plans.runlog import RunLog
from tapeline.schemas import (
    CARRIED_TABLE_TYPES,
    CLOSE_TABLE_TYPES,
    DAY_GROUP_KEY,
    DAY_SYMBOL_KEY,
    ENRICHED_COLUMNS,
    EVENT_TABLE_TYPES,
    QUOTE,
    QUOTE_TABLE_TYPES,
    QUOTE_TYPES,
    SOURCE_KEY,
    TRADE,
    TRADE_TABLE_TYPES,
    TRADE_TYPES,
    schema_of,
)
from tapeline.sources.messages import no_lines, origins_of, read_lines
from tapeline.sources.staging import stage, staging_scope
from tapeline.sources.tables import on_dates, read_daily
from tapeline.sources.versions import (
    Version,
    Versions,
    notes,
    remove_superseded,
    replace_partitions,
    snapshot,
    within,
    written,
)

HALF_HOUR = 1800
#: the order within files of the daily tables
BY_SYMBOL = ("symbol", "exchange", "event_tm", "event_seq_nb")
#: kept with each run of the event table: the trade dates it changed
CHANGED = "changed"
#: kept with each run of the carried closes: the event runs that the load took in
LOADED = "loaded"


def ingest(
    spark: SparkSession, csv_paths: str | Sequence[str], json_paths: str | Sequence[str]
) -> DataFrame:
    """Events of all message files, with the date of their folder."""
    return all_events(read_lines(spark, csv_paths), read_lines(spark, json_paths), "src_date")


def load_trades(events: DataFrame) -> DataFrame:
    """Latest version of every trade in the T partition."""
    return keep_latest(trade_rows(events.where(F.col("partition") == TRADE)))


def load_quotes(events: DataFrame) -> DataFrame:
    """Latest version of every quote in the Q partition."""
    return keep_latest(quote_rows(events.where(F.col("partition") == QUOTE)))


def enrich_quotes(
    trades: DataFrame,
    quotes: DataFrame,
    closes: DataFrame | None = None,
    length_seconds: int = HALF_HOUR,
    calendar_day: bool = False,
    include_bid_pr: bool = False,
) -> DataFrame:
    """Quotes with the trade price and average current at their time, and the
    previous close (E3).

    ``trades`` and ``quotes`` hold the latest version of each event and are
    read several times: pass stored tables.  Each trade date stands for itself,
    so one run over many days equals one run per day; ``closes`` then has to
    hold the earlier days' closing prices.  By default it is derived from
    ``trades``.
    """
    points = trade_points(trades, length_seconds, DAY_SYMBOL_KEY, DAY_GROUP_KEY)
    previous = prev_close(
        last_price(trades, one_version=True) if closes is None else closes, quotes, calendar_day
    )
    filled = fill_asof(quotes, points, of_key=stage(previous, "prev_close"))
    columns = [*ENRICHED_COLUMNS, *(["bid_pr"] if include_bid_pr else [])]
    return filled.withColumnRenamed("trade_pr", "latest_trade_pr").select(*columns)


def enrich_quotes_eod(
    trades: DataFrame, quotes: DataFrame, length_seconds: int = HALF_HOUR
) -> DataFrame:
    """Quotes with the day's last values and the same day's close.

    The steps as first written, with complete join keys: a quote sees the end
    of its own day, and a key whose last event is a quote sees NULLs.  Quotes are
    told by their record type, so one without an ask size stays.
    """
    averaged = moving_average(trades, length_seconds, DAY_SYMBOL_KEY)
    combined = stage(combine(averaged, quotes, include_rec_type=True), "combined")
    filled = fill_latest_eod(combined, one_version=True).where(F.col(REC_TYPE) == QUOTE)
    return join_close(filled, stage(last_price(trades, one_version=True), "close")).select(*ENRICHED_COLUMNS)


def _dates(dates: Sequence[str] | str | None) -> list[str] | None:
    return [dates] if isinstance(dates, str) else None if dates is None else list(dates)


def _covered(dates: Sequence[str | None] | None, column: str = "trade_dt") -> list[dict]:
    """What a run over ``dates`` replaces of a table by trade date; without, all of it."""
    return [{}] if dates is None else [{column: day} for day in dates]


def run_ingest(
    spark: SparkSession,
    csv_paths: str | Sequence[str] | None,
    json_paths: str | Sequence[str] | None,
    events_path: str,
    log_path: str,
    bad_path: str | None = None,
) -> None:
    """Ingest message files, of either format or both, into the event table.

    The table is partitioned by file date, format and exchange, then by the trade
    date in the message and the record type.  A run replaces all that the table
    holds of the folders it read, in one step, and nothing else.  With the run it records
    the trade dates of the rows that it replaced or wrote, for the load job.  Bad rows have
    no fields in the event table; ``bad_path`` keeps the text of their lines.
    """
    with RunLog(spark, log_path).job("ingest"):
        given = [read_lines(spark, paths) if paths else None for paths in (csv_paths, json_paths)]
        found = [origin for lines in given if lines is not None for origin in origins_of(lines)]
        covered = [{c: origin[c] for c in SOURCE_KEY} for origin in found]
        csv, json = (no_lines(spark) if lines is None else lines for lines in given)
        events = all_events(csv, json, *SOURCE_KEY)
        events = events.withColumn("trade_day", F.col("trade_dt").try_cast("date"))
        with written() as versions:
            by = [*SOURCE_KEY, "trade_day", "partition"]
            # a file's bad rows, which have no trade date, along with those of its own date
            day = F.coalesce("trade_day", "src_date")
            version = versions.add(events, events_path, by, covered, together=day)
            if bad_path is not None:
                versions.add(bad_records(csv, json, *SOURCE_KEY), bad_path, SOURCE_KEY, covered)
            days = version.values_of("trade_day")  # dates, not rows
            before = snapshot(spark, events_path).holding(covered)
            if before.runs:
                replaced = before.read(schema_of(EVENT_TABLE_TYPES)).where(within(covered))
                rows = replaced.select(F.col("trade_day").cast("string")).distinct().collect()
                days |= {row.trade_day for row in rows}
            version.note(CHANGED, sorted(days, key=lambda day: day or ""))


def changed_dates(
    spark: SparkSession, events_path: str, tables_path: str
) -> tuple[list[str], list[str | None]]:
    """Event runs that no load has taken in yet, and the trade dates they changed.

    A date is None where rows without a proper trade date changed.
    """
    published = snapshot(spark, events_path).runs
    if not published:
        raise FileNotFoundError(f"{events_path} has no published run")
    carried = f"{tables_path}/carried"  # published last
    loaded = set(notes(spark, carried, LOADED, snapshot(spark, carried).runs))
    runs = [run for run in published if run not in loaded]
    changed = set(notes(spark, events_path, CHANGED, runs))
    return runs, sorted(changed, key=lambda day: day or "")


def run_load(
    spark: SparkSession,
    events_path: str,
    tables_path: str,
    log_path: str,
    dates: Sequence[str] | str | None = None,
    everything: bool = False,
    zone: str | None = None,
) -> list[str | None] | None:
    """Rebuild the daily ``trade``, ``quote``, ``close`` and ``rejected_*`` tables, and ``carried``,
    the closes last known at the end of each month.

    Without ``dates``, those dates are rebuilt that ingested files changed since they were
    last loaded: a late correction rebuilds its own trade date, whatever its file's date.
    ``dates`` are the trade dates to rebuild instead; ``everything`` rebuilds all, and is
    the only way to mend tables that were changed by hand.  Each date is rebuilt from the
    events of all files that hold it, and the event table is pruned to them.  Rows whose trade
    date is no date are rejected, and rebuilt when such rows changed or with everything.
    Times are local to ``zone``; without it, times with an offset or a zone are rejected.

    All tables are written first and then published, one rename each.  The last one holds
    which event runs are loaded, so a run that stops is done again by the next one.
    Returns the dates that were rebuilt, None for all.
    """
    dates = _dates(dates)
    with RunLog(spark, log_path).job("load"):
        taken: Sequence[str] = []
        if dates is None:
            taken, changed = changed_dates(spark, events_path, tables_path)
            dates = None if everything else changed
        if dates == []:
            return dates
        state = snapshot(spark, events_path)
        # one listing of its folders for all that is read of it
        on_days = on_dates(state.read(schema_of(EVENT_TABLE_TYPES)), dates, "trade_day")
        with written() as versions:
            for record_type, name, types in (
                (TRADE, "trade", TRADE_TYPES),
                (QUOTE, "quote", QUOTE_TYPES),
            ):
                events = on_days.where(F.col("partition") == record_type)
                latest = keep_latest(typed_rows(events, types, zone))
                path = f"{tables_path}/{name}"
                version = versions.add(latest, path, ["trade_dt"], _covered(dates), BY_SYMBOL)
                rejected = rejected_rows(events, types, "trade_day", "src_date", zone=zone)
                path = f"{tables_path}/rejected_{name}"
                versions.add(rejected, path, ["trade_day"], _covered(dates, "trade_day"))
                if record_type == TRADE:
                    trades = version.read()
            closes = last_price(trades, one_version=True)
            close = versions.add(
                closes, f"{tables_path}/close", ["trade_dt"], _covered(dates), few_rows=True
            )
            last = _carry(spark, tables_path, close.read(), dates, versions)
            last.note(LOADED, state.runs if dates is None else taken)
    return dates


def _carry(
    spark: SparkSession,
    tables_path: str,
    closes: DataFrame,
    dates: Sequence[str | None] | None,
    versions: Versions,
) -> Version:
    """Bring the ``carried`` closes up to date with the rebuilt ``closes`` of ``dates``.

    Those of earlier months stay; from the first month with a rebuilt date on, they are carried anew.
    """
    path, by = f"{tables_path}/carried", ["month"]
    none = spark.createDataFrame([], schema_of(CARRIED_TABLE_TYPES))
    days = [day for day in dates or () if day]
    if dates is None:
        last = closes.agg(F.max("trade_dt")).first()[0]
        return versions.add(carried_closes(closes, none, None, last) if last else none, path, by, [{}])
    if not days:
        return versions.add(none, path, by, [])
    first = date.fromisoformat(min(days)).replace(day=1)
    stored, state = snapshot(spark, f"{tables_path}/close"), snapshot(spark, path)
    if stored.runs:
        later = on_dates(stored.read(schema_of(CLOSE_TABLE_TYPES)), days, outside=True)
        closes = closes.unionByName(later.where(F.col("trade_dt") >= F.lit(first)))
    carried = state.read(none.schema) if state.runs else none
    last_carried = carried.agg(F.max("month")).first()[0]
    last_close = closes.agg(F.max("trade_dt")).first()[0]
    last = max(day for day in (first, last_carried, last_close) if day).replace(day=1)
    rows = carried_closes(closes, _carried_before(carried, first), first, last).where(F.col("month") >= F.lit(first))
    covered = [first]
    while covered[-1] < last:
        covered.append((covered[-1] + timedelta(days=32)).replace(day=1))
    return versions.add(rows, path, by, [{"month": month.isoformat()} for month in covered])


def _carried_before(carried: DataFrame, first: date) -> DataFrame:
    """The closes carried to the last month end before the month ``first``."""
    earlier = carried.where(F.col("month") < F.lit(first))
    return earlier.where(F.col("month") == F.lit(earlier.agg(F.max("month")).first()[0])).drop("month")


def closes_before(
    spark: SparkSession, tables_path: str, dates: Sequence[str] | None
) -> DataFrame:
    """The closing prices that the previous close of ``dates`` can come from.

    Those last known at the end of the month before the first date, and all from that month to
    the last date: however long the history, two months' folders and those of ``dates`` are read.
    """
    closes = read_daily(spark, f"{tables_path}/close", types=CLOSE_TABLE_TYPES)
    if not dates:
        return closes
    first = date.fromisoformat(min(dates)).replace(day=1)
    between = F.col("trade_dt").between(F.lit(first), F.lit(date.fromisoformat(max(dates))))
    state = snapshot(spark, f"{tables_path}/carried")
    if not state.runs:  # tables that were loaded before closes were carried
        return closes
    carried = _carried_before(state.read(schema_of(CARRIED_TABLE_TYPES)), first)
    return closes.where(between).unionByName(carried)


def run_enrich(
    spark: SparkSession,
    tables_path: str,
    output_path: str,
    log_path: str,
    dates: Sequence[str] | str | None = None,
    end_of_day: bool = False,
    calendar_day: bool = False,
    include_bid_pr: bool = False,
) -> None:
    """Write the enriched quotes of the given trade dates.

    Trades and quotes are read for those dates only, earlier closing prices from
    the month before; see :func:`closes_before`.  ``end_of_day`` writes the form of
    :func:`enrich_quotes_eod`, to which the later options do not apply.  Any of the
    tables may be without rows: without quotes nothing is written, and without
    trades or closes the quotes' values are NULL.
    """
    dates = _dates(dates)
    with RunLog(spark, log_path).job("enrich"), staging_scope(spark):
        trades = read_daily(spark, f"{tables_path}/trade", dates, TRADE_TABLE_TYPES)
        quotes = read_daily(spark, f"{tables_path}/quote", dates, QUOTE_TABLE_TYPES)
        if end_of_day:
            enriched = enrich_quotes_eod(trades, quotes)
        else:
            closes = closes_before(spark, tables_path, dates)
            enriched = enrich_quotes(
                trades,
                quotes,
                closes,
                calendar_day=calendar_day,
                include_bid_pr=include_bid_pr,
            )
        replace_partitions(enriched, output_path, ["trade_dt"], _covered(dates), BY_SYMBOL)


def run_clean(spark: SparkSession, paths: Sequence[str], log_path: str, keep_hours: float = 24) -> int:
    """Delete from the tables at ``paths`` what later runs replaced over ``keep_hours`` ago.

    The run log's changes of the days before yesterday are gathered in few files.
    """
    now = datetime.now(timezone.utc)
    log = RunLog(spark, log_path)
    with log.job("clean"):
        removed = sum(remove_superseded(spark, path, now - timedelta(hours=keep_hours)) for path in paths)
        log.compact(now.date() - timedelta(days=1))
        return removed
