"""Partitioned Parquet tables: the event table and the daily tables."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.schemas import schema_of
from tapeline.sources.versions import read_table, spreading


def write_partitioned(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``rows`` holds.

    One write for the whole input: a second overwrite of the same folder would
    remove what the first one wrote.  A stored partition that ``rows`` has no
    row of stays as it is, and readers see one partition after the other change; see
    ``versions.replace_partitions``.  The rows of a
    partition are shuffled into few files, and AQE splits a partition that is too
    big for one task.
    """
    with spreading(rows.sparkSession):
        (
            rows.hint("rebalance", *by)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(path)
        )


def read_events(spark: SparkSession, path: str, record_type: str) -> DataFrame:
    """One record type of the event table (S6, F3); other folders are not read."""
    return read_table(spark, path).where(F.col("partition") == record_type)


def on_dates(
    rows: DataFrame,
    dates: Sequence[str | None] | str | None,
    column: str = "trade_dt",
    outside: bool = False,
) -> DataFrame:
    """Rows of the given trade dates (F1, S8), or those ``outside`` of them.

    ``None`` keeps every date, ``[None]`` rows without one.
    """
    if dates is None:
        return rows
    wanted = [dates] if isinstance(dates, str) else list(dates)
    there = among(column, wanted)
    if None in wanted:
        there = there | F.col(column).isNull()
    return rows.where(~there if outside else there)


def among(column: str, dates: Iterable[str | None]) -> Column:
    """Whether ``column`` is one of the dates that are not None.

    One text of SQL: thousands of dates, each made a column of its own, take seconds.
    """
    days = sorted({str(day) for day in dates if day is not None})
    if not days:
        return F.col(column).isin([])
    quoted = [day.replace("\\", r"\\").replace("'", r"\'") for day in days]
    return F.expr(f"`{column}` IN ({', '.join(f"CAST('{day}' AS DATE)" for day in quoted)})")


def read_daily(
    spark: SparkSession,
    path: str,
    dates: Sequence[str] | str | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """A daily table, pruned to the folders of the given trade dates.

    A table without rows has no files to tell its columns; ``types`` does.
    """
    return on_dates(read_table(spark, path, types and schema_of(types)), dates)
