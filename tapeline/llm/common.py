"""Helpers that the operators share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.sources.staging import stage

__all__ = ["fresh", "rows_per_batch", "stage", "table", "with_key"]

BATCH_ROWS = 256  # rows of whole texts that a Python worker holds at once


def rows_per_batch(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of one Arrow batch: texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(rows: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``rows`` is called so."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_key(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """``docs`` and a long ``key`` that no two rows share, in order of id.

    Where ids are unique and not null, as they should be, the key is the id. Otherwise
    rows are numbered in order of id (null last) and text, and written, so that the
    numbers hold when a lost executor's work is done again.
    """
    shared = docs.groupBy(F.col(id_col).alias("id")).count().filter("count > 1 or id is null")
    if shared.isEmpty():
        return docs.withColumn(key, F.col(id_col).cast("long"))
    ordered = docs.sort(F.col(id_col).asc_nulls_last(), F.col(text_col).asc_nulls_first())
    return stage(ordered.withColumn(key, F.monotonically_increasing_id()), "keyed")

