from datetime import datetime, timedelta

import pytest

from tables import values
from tapeline.plans.runlog import RunLog, latest_status
from tapeline.schemas import RUN_LOG_SCHEMA


def test_latest_status_is_by_time_not_by_row_order(spark):
    start = datetime(2020, 8, 5, 9)
    changes = {"j-1": ["starting", "running", "success"], "j-2": ["starting", "failed"]}
    rows = [
        ("j", f"{job}{i}", start + timedelta(seconds=i), job, status, None, None)
        for job, statuses in changes.items()
        for i, status in enumerate(statuses)
    ]
    for order in (rows, rows[::-1]):
        log = spark.createDataFrame(order, RUN_LOG_SCHEMA)
        assert values(latest_status(log), "job_id", "status") == [
            ("j-1", "success"), ("j-2", "failed"),
        ]


def test_job_records_its_states(spark, tmp_path):
    log = RunLog(spark, f"{tmp_path}/log")
    with log.job("load"):
        pass
    with pytest.raises(ZeroDivisionError):
        with log.job("Other"):
            raise ZeroDivisionError("no luck")
    rows = log.rows().orderBy("ts").collect()
    assert [(r["job_name"], r["status"], r["error"]) for r in rows] == [
        ("load", "starting", None), ("load", "running", None), ("load", "success", None),
        ("Other", "starting", None), ("Other", "running", None), ("Other", "failed", "no luck"),
    ]
    assert len({r["row_key"] for r in rows}) == 6
    job_id = rows[0]["job_id"]
    assert job_id == f"load-{rows[0]['ts']:%Y-%m-%d}"
    assert log.status_of(job_id) == "success"
    assert log.status_of("unknown") is None


def test_trouble_with_the_log_does_not_fail_the_job(spark, tmp_path):
    (tmp_path / "file").write_text("not a folder")
    done = []
    with RunLog(spark, f"{tmp_path}/file/log").job("load"):
        done.append(1)
    assert done == [1]


def test_runs_of_one_day_are_told_apart(spark, tmp_path):
    log = RunLog(spark, f"{tmp_path}/log")
    with log.job("load") as first:
        with pytest.raises(ZeroDivisionError):
            with log.job("load") as second:
                raise ZeroDivisionError("no luck")
    assert values(latest_status(log.rows(), "run_id"), "run_id", "status") == sorted(
        [(first, "success"), (second, "failed")]
    )
    assert log.status_of(first) == "success" and log.status_of(second) == "failed"
    assert latest_status(log.rows()).count() == 1


def test_past_days_are_gathered_in_few_files(spark, tmp_path):
    log = RunLog(spark, f"{tmp_path}/log")
    for n in range(12):
        day = datetime(2020, 8, 3 + n % 3, 9, n)
        row = ("j", str(n), day, f"j-{day:%Y-%m-%d}", "running", None)
        names = RUN_LOG_SCHEMA.names[:-1]
        log.append(spark.createDataFrame([row], "job_name string, row_key string, ts timestamp, job_id string, status string, error string").toDF(*names))
    before = values(log.rows(), *RUN_LOG_SCHEMA.names)

    def files():
        return sorted(p.parent.name for p in (tmp_path / "log").rglob("*.parquet"))

    assert len(files()) == 12
    log.compact(datetime(2020, 8, 5).date())
    assert files() == ["log_day=2020-08-03", "log_day=2020-08-04", *["log_day=2020-08-05"] * 4]
    assert values(log.rows(), *RUN_LOG_SCHEMA.names) == before and len(before) == 12
    log.compact(datetime(2020, 8, 5).date())
    assert len(files()) == 6
