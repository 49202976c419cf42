"""Run registered queries in Spark and their SQL in DuckDB and compare the rows.

    python -m checks.compare /root/testdata/sf0.01 [query ...]
"""

import math
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.queries import registered
from tapeline.settings import configured
from tapeline.sources.staging import staging_scope

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _value(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, db, sf_dir: str, name: str) -> str | None:
    """None if both sides give the same columns and rows, else what differs."""
    result = registered()[name](spark, sf_dir)
    answer = db.execute(ORACLE[name])
    columns = [column[0] for column in answer.description]
    if sorted(columns) != sorted(result.columns):
        return f"columns {sorted(result.columns)} but SQL has {sorted(columns)}"
    ours = _bag(result.columns, result.collect())
    theirs = _bag(columns, answer.fetchall())
    if ours == theirs:
        return None
    return (
        f"{ours.total()} rows but SQL has {theirs.total()}; only here "
        f"{list((ours - theirs).items())[:3]}; only in SQL {list((theirs - ours).items())[:3]}"
    )


def main() -> None:
    with tempfile.TemporaryDirectory(prefix="tapeline-") as shared:
        compare_all(shared)


def compare_all(shared: str) -> None:
    sf_dir, *names = sys.argv[1:]
    spark = (
        configured(SparkSession.builder)
        .master("local[8]")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb_tables(sf_dir)
    wrong = 0
    for name in names or registered():
        start = time.time()
        try:
            with staging_scope(spark):
                found = difference(spark, db, sf_dir, name)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += found is not None
        print(f"{name:28s} {time.time() - start:6.2f} s  {found or 'same'}", flush=True)
    sys.exit(1 if wrong else 0)


if __name__ == "__main__":
    main()
