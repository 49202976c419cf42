from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import types as T

from tables import values
from tapeline.sources import versions
from tapeline.sources.messages import origins
from tapeline.sources.versions import (
    Version,
    read_table,
    remove_superseded,
    replace_partitions,
    snapshot,
    spreading,
    within,
    written,
)

BY = ["d", "e"]
SCHEMA = T.StructType().add("v", T.IntegerType()).add("d", T.DateType()).add("e", T.StringType())
MON, TUE = "2020-08-03", "2020-08-04"


def rows_of(spark, rows):
    frame = spark.createDataFrame(rows, "d string, e string, v int")
    return frame.withColumn("d", frame["d"].cast("date"))


def put(spark, path, rows, covered):
    return replace_partitions(rows_of(spark, rows), path, BY, covered)


def held(spark, path):
    return values(read_table(spark, path, SCHEMA), "d", "e", "v")


def test_a_run_replaces_what_it_covers(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [(MON, "x", 1), (MON, "y", 2), (TUE, "x", 3), (None, "x", 4), (TUE, None, 5)], [{}])
    assert len(held(spark, path)) == 5
    put(spark, path, [(MON, "x", 10)], [{"d": MON}])
    assert held(spark, path) == [(MON, "x", 10), (TUE, "x", 3), (TUE, None, 5), (None, "x", 4)]
    put(spark, path, [], [{"d": None}, {"d": "2020-08-09"}])
    assert held(spark, path) == [(MON, "x", 10), (TUE, "x", 3), (TUE, None, 5)]
    put(spark, path, [], [{}])
    assert held(spark, path) == []
    put(spark, path, [(TUE, "x", 7)], [{"d": TUE}])
    assert held(spark, path) == [(TUE, "x", 7)]


def test_parts_by_several_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [(MON, "x", 1), (MON, None, 2)], [{"d": MON, "e": "x"}, {"d": MON, "e": None}])
    put(spark, path, [(MON, "y", 3)], [{"e": "y", "d": MON}])
    put(spark, path, [(MON, None, 4)], [{"d": MON, "e": None}])
    assert held(spark, path) == [(MON, "x", 1), (MON, "y", 3), (MON, None, 4)]
    with pytest.raises(ValueError, match="not the first"):
        put(spark, path, [], [{"e": "y"}])
    with pytest.raises(ValueError, match="different columns"):
        put(spark, path, [], [{"d": MON}, {"d": MON, "e": "x"}])


def test_a_run_that_stops_leaves_the_table_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [(MON, "x", 1), (TUE, "x", 2)], [{}])
    stopped = Version(rows_of(spark, [(MON, "x", 9)]), path, BY, [{"d": MON}])
    assert held(spark, path) == [(MON, "x", 1), (TUE, "x", 2)]
    assert values(stopped.read(), "v") == [(9,)]
    stopped.publish()
    assert held(spark, path) == [(MON, "x", 9), (TUE, "x", 2)]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [(MON, "x", 1)], [{"d": MON}])
    reading = read_table(spark, path, SCHEMA)
    put(spark, path, [(MON, "x", 2)], [{"d": MON}])
    assert values(reading, "v") == [(1,)]
    assert held(spark, path) == [(MON, "x", 2)]


def test_several_tables_are_published_together_or_not_at_all(spark, tmp_path):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    with pytest.raises(ZeroDivisionError), written() as tables:
        tables.add(rows_of(spark, [(MON, "x", 1)]), a, BY, [{}])
        raise ZeroDivisionError
    assert not list((tmp_path / "a").iterdir())
    with written() as tables:
        tables.add(rows_of(spark, [(MON, "x", 1)]), a, BY, [{}])
        tables.add(rows_of(spark, [(MON, "y", 1)]), b, BY, [{}])
        assert not snapshot(spark, a).runs
    assert held(spark, a) == [(MON, "x", 1)] and held(spark, b) == [(MON, "y", 1)]


def test_superseded_folders_are_pruned_and_later_deleted(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(spark, path, [(MON, "x", 1), (TUE, "x", 2)], [{}])
    put(spark, path, [(MON, "x", 3)], [{"d": MON}])
    read = read_table(spark, path, SCHEMA)
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [" in plan and "Filter [" not in plan  # folders are left out, no rows
    files = {f.rsplit("/t/", 1)[1].split("/", 1)[1].rsplit("/", 1)[0] for f in read.select("_metadata.file_path").toPandas().file_path}
    assert files == {f"d={MON}/e=x", f"d={TUE}/e=x"}
    Version(rows_of(spark, []), path, BY, [{}])  # a run that stopped
    now = datetime.now(timezone.utc)
    assert remove_superseded(spark, path, now - timedelta(hours=1)) == 0
    assert remove_superseded(spark, path, now + timedelta(seconds=1)) == 2
    assert sorted(p.parent.parent.name for p in (tmp_path / "t").rglob("*.parquet")) == [f"d={MON}", f"d={TUE}"]
    assert held(spark, path) == [(MON, "x", 3), (TUE, "x", 2)]
    put(spark, path, [(TUE, "x", 5)], [{}])
    assert remove_superseded(spark, path, datetime.now(timezone.utc) + timedelta(seconds=1)) == 2
    assert held(spark, path) == [(TUE, "x", 5)]


def test_missing_and_plain_tables(spark, tmp_path):
    with pytest.raises(Exception, match="nothing"):
        read_table(spark, f"{tmp_path}/nothing", SCHEMA)
    with pytest.raises(FileNotFoundError):
        snapshot(spark, f"{tmp_path}/nothing").read(SCHEMA)
    rows_of(spark, [(MON, "x", 1)]).write.partitionBy("d").parquet(f"{tmp_path}/plain")
    assert values(read_table(spark, f"{tmp_path}/plain"), "v") == [(1,)]
    with pytest.raises(ValueError, match="outside of any run"):
        put(spark, f"{tmp_path}/plain", [], [{}])


def test_rows_within_parts(spark):
    rows = rows_of(spark, [(MON, "x", 1), (None, "x", 2), (TUE, None, 3)])
    assert values(rows.where(within([{"d": MON}, {"d": None}])), "v") == [(1,), (2,)]
    assert values(rows.where(within([{"d": TUE, "e": None}])), "v") == [(3,)]
    assert rows.where(within([{}])).count() == 3 and rows.where(within([])).count() == 0


def test_many_runs_make_one_filter(spark, tmp_path):
    path = f"{tmp_path}/t"
    days = [f"2020-08-{d:02}" for d in range(1, 13)]
    put(spark, path, [(d, "x", 0) for d in days], [{}])
    for n, day in enumerate(days, 1):
        put(spark, path, [(day, "x", n)], [{"d": day}])
    put(spark, path, [(days[0], "x", 99)], [{"d": days[0]}])
    state = snapshot(spark, path)
    assert len(state.superseded) == 13 and len(state.runs) == 14
    assert values(state.read(SCHEMA), "d", "v") == [(days[0], 99), *[(d, n) for n, d in enumerate(days[1:], 2)]]


def test_folders_of_files_are_found_without_their_names(spark, tmp_path, monkeypatch):
    for name in ("csv/2020-08-03/NY SE/a.txt", "csv/2020-08-03/NY SE/b.txt", "csv/2020-08-04/AR+CA/a.txt", "odd.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("")
    found = origins(spark, str(tmp_path))
    assert sorted((o["src_format"] or "", o["src_date"], o["src_exchange"]) for o in found) == [
        ("", None, None), ("csv", "2020-08-03", "NY SE"), ("csv", "2020-08-04", "AR+CA"),
    ]
    assert versions._children(spark, f"{tmp_path}/nothing") == []


def test_a_filter_on_symbol_skips_row_groups(spark, tmp_path, settings):
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F

    path = f"{tmp_path}/t"
    rows = spark.range(200_000).select(
        F.lit(MON).cast("date").alias("d"),
        F.concat(F.lit("S"), F.lpad((F.col("id") * 7919 % 100).cast("string"), 2, "0")).alias("symbol"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )
    store = spark._jsc.hadoopConfiguration()
    store.set("parquet.block.size", str(256 * 1024))
    try:
        replace_partitions(rows, path, ["d"], [{}], ["symbol", "v"])
    finally:
        store.unset("parquet.block.size")
    groups = []
    for file in (tmp_path / "t").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().get_field_index("symbol")
        groups += [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    holding = [g for g in groups if g.min <= "S42" <= g.max]
    assert len(groups) > 20 and len(holding) <= len(groups) // 5
    read = read_table(spark, path).where("symbol = 'S42'")
    assert read.count() == 2000
    plan = spark._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "formatted")
    assert "EqualTo(symbol,S42)" in plan


def test_small_parts_are_written_by_several_tasks(spark, tmp_path):
    days = [f"2020-08-{d:02}" for d in range(1, 25)]
    rows = rows_of(spark, [(day, "x", n) for n, day in enumerate(days)])
    path = f"{tmp_path}/t"
    with written() as tables:
        version = tables.add(rows, path, BY, [{}], few_rows=True)
        assert version.values_of("d") == set(days) and version.values_of("e") == {"x"}
    files = [p.name for p in (tmp_path / "t").rglob("*.parquet")]
    assert len(files) == 24 and len({name[:10] for name in files}) > 2
    assert [v for _, _, v in held(spark, path)] == list(range(24))


def test_values_of_partitions_are_told_by_folders(spark, tmp_path):
    odd = Version(rows_of(spark, [(None, "a/b c", 1), (MON, None, 2)]), f"{tmp_path}/t", BY, [{}])
    assert odd.values_of("d") == {None, MON} and odd.values_of("e") == {None, "a/b c"}
    assert Version(rows_of(spark, []), f"{tmp_path}/u", BY, [{}]).values_of("d") == set()


def test_runs_that_hold_nothing_of_a_part_are_left_out(spark, tmp_path):
    path = f"{tmp_path}/t"
    for day in (MON, TUE):
        put(spark, path, [(day, "x", 1)], [{"d": day}])
    state = snapshot(spark, path)
    assert state.holding([{"d": TUE}]).runs == state.runs[1:]
    assert state.holding([{"d": None}]).runs == () and state.holding([{}]).runs == state.runs
    put(spark, path, [(MON, "x", 2)], [{}])
    state = snapshot(spark, path)
    assert state.holding([{"d": TUE}]).runs == state.runs


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    days = spark.range(300).selectExpr("cast(id as int) as v", "date_add(date'2020-01-01', int(id)) as d", "'x' as e")
    days.coalesce(1).write.partitionBy(*BY).parquet(f"{tmp_path}/t")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "")
    try:
        spark.read.schema(SCHEMA).parquet(f"{tmp_path}/t")
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("listing")]
        tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert tasks and max(tasks) <= 200


def test_few_rows_in_many_folders_are_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(6000).selectExpr("uuid() as v", "date_add(date'2020-01-01', int(id % 300)) as d")
    version = Version(rows, f"{tmp_path}/t", ["d"], [{}])
    files = [f.name for f in tmp_path.rglob("*.parquet")]
    assert len(files) == 300  # one in each folder all the same
    assert len({name.split("-")[1] for name in files}) > 1
    assert version.read().count() == 6000


def test_session_settings_are_left_as_they_were(spark, settings):
    by_core = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    least = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    settings({by_core: "3"})
    with pytest.raises(KeyError), spreading(spark):
        assert spark.conf.get(by_core) == "3"  # the session's own
        assert spark.conf.get(least, None) == "16k"
        raise KeyError
    assert spark.conf.get(by_core) == "3"
    assert spark.conf.get(least, None) is None


def test_tables_are_listed_by_few_tasks_in_any_session(spark, settings, tmp_path):
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    days = spark.range(300).selectExpr("cast(id as int) as v", "date_add(date'2020-01-01', int(id)) as d", "'x' as e")
    replace_partitions(days, f"{tmp_path}/t", BY, [{}])
    settings({name: "1"})  # put back after the test
    spark.conf.unset(name)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing versions", "")
    try:
        read_table(spark, f"{tmp_path}/t", SCHEMA)
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("listing versions")]
        tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert tasks and max(tasks) <= 200
