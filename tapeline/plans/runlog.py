"""Log of job runs: one row per status change."""

import logging
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.schemas import RUN_LOG_SCHEMA
from tapeline.sources.staging import stage, staging_scope
from tapeline.sources.tables import write_partitioned

STARTING, RUNNING, SUCCESS, FAILED = "starting", "running", "success", "failed"

#: partition column of the stored log
LOG_DAY = "log_day"
_DDL = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in RUN_LOG_SCHEMA)

_logger = logging.getLogger(__name__)


def job_id(job_name: Column, ts: Column) -> Column:
    """Job name and run date, as in ``load-2020-08-05``."""
    return F.concat_ws("-", job_name, F.date_format(ts, "yyyy-MM-dd"))


def latest_status(log: DataFrame, by: str = "job_id") -> DataFrame:
    """Last status of each job id, or ``by`` run id of each run, by time.

    Two runs of a job on one day share their job id, but not their run id.
    """
    known = log.where(F.col(by).isNotNull())
    return known.groupBy(by).agg(F.max_by("status", F.struct("ts", "row_key")).alias("status"))


class RunLog:
    """A Parquet table of status changes at ``path``, by the day of the change.

    Each change is a file of its own until :meth:`compact` gathers those of past days.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def record(
        self,
        job_name: str,
        status: str,
        error: str | None = None,
        started: datetime | None = None,
        run_id: str | None = None,
    ) -> None:
        """Append one status change (R2).  Trouble with the log only warns.

        The job id is that of the day on which the run ``started``, now by default.
        """
        now = datetime.now(timezone.utc)
        row = (job_name, str(uuid.uuid4()), now, "", status, error, run_id)
        try:
            change = self.spark.createDataFrame([row], RUN_LOG_SCHEMA)
            self.append(change.withColumn("job_id", job_id(F.col("job_name"), F.lit(started or now))))
        except Exception:
            _logger.warning(
                "run log %s: no row for %s %s", self.path, job_name, status, exc_info=True
            )

    def append(self, changes: DataFrame) -> None:
        """Append status changes, such as those of another log (S9); they may lack a run id."""
        if "run_id" not in changes.columns:
            changes = changes.withColumn("run_id", F.lit(None).cast("string"))
        rows = changes.select(*RUN_LOG_SCHEMA.names, F.to_date("ts").alias(LOG_DAY))
        few = rows.hint("rebalance", LOG_DAY)  # one file a day of what is appended
        few.write.mode("append").partitionBy(LOG_DAY).parquet(self.path)

    def rows(self) -> DataFrame:
        return self._stored().drop(LOG_DAY)

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(f"{_DDL}, {LOG_DAY} date").parquet(self.path)

    def status_of(self, wanted: str) -> str | None:
        """Last status of one job id or run id, or None if it has no rows."""
        mine = self.rows().where((F.col("job_id") == wanted) | (F.col("run_id") == wanted))
        found = mine.orderBy(F.desc("ts"), F.desc("row_key")).select("status").first()
        return found["status"] if found else None

    def compact(self, before: date) -> None:
        """Gather the changes of each day before ``before`` in one file, or as few as Spark makes.

        Days to which rows are still appended are not to be among them.  The rows are
        written apart first; Spark then replaces the folders of those days.
        """
        with staging_scope(self.spark):
            past = stage(self._stored().where(F.col(LOG_DAY) < F.lit(before)), "run-log")
            write_partitioned(past, self.path, [LOG_DAY])

    @contextmanager
    def job(self, job_name: str) -> Iterator[str]:
        """Log a job's start and end around its work; its error is raised again.

        Yields the id of the run, which all its rows carry.
        """
        started, run_id = datetime.now(timezone.utc), str(uuid.uuid4())
        self.record(job_name, STARTING, started=started, run_id=run_id)
        try:
            self.record(job_name, RUNNING, started=started, run_id=run_id)
            yield run_id
        except Exception as error:
            self.record(job_name, FAILED, str(error), started, run_id)
            raise
        self.record(job_name, SUCCESS, started=started, run_id=run_id)
