"""Tables in versions: each run's partitions in a folder of their own, published by one rename.

A table is a folder of runs, ``run=<time>-<random>/<partitions>``. A run replaces all that its
inputs covered, and names that in ``_covered``, hidden from Spark, as a JSON object a line:
values, as text, of leading partition columns (``{}`` for the whole table). What a later run
covers is no part of the table any more. Readers filter it out by partition columns, so
Spark prunes its folders; the files stay until :func:`remove_superseded`, for those who still
read them. While a run writes, its folder is hidden, and a run that stops leaves the table as it was.
"""

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN = "run"
_TIME = "%Y%m%dT%H%M%S%f"
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
Spec = Mapping[str, str | None]


def _store(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` as one of its own."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in one folder: runs or partition values, never data files."""
    store, at = _store(spark, path)
    return [s.getPath().getName() for s in store.listStatus(at)] if store.exists(at) else []


def folders_of(rows: DataFrame) -> DataFrame:
    """Each ``folder`` once that the files of ``rows`` lie in; file names stay in the JVM."""
    spark, files = rows.sparkSession, rows._jdf.inputFiles()
    jvm = spark._jvm
    listed = jvm.scala.jdk.javaapi.CollectionConverters.asJava(jvm.scala.Predef.genericWrapArray(files))
    names = spark._jsparkSession.createDataset(listed, jvm.org.apache.spark.sql.Encoders.STRING())
    folder = F.regexp_replace("value", "/[^/]+$", "/")
    return DataFrame(names.toDF(), spark).select(folder.alias("folder")).distinct()


@contextmanager
def _settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the block; those that the session sets itself stay as they are."""
    own = [name for name in values if spark.conf.get(name, None) is None]
    for name in own:
        spark.conf.set(name, values[name])
    try:
        yield
    finally:
        for name in own:
            spark.conf.unset(name)


def spreading(spark: SparkSession) -> AbstractContextManager[None]:
    """For writing by folders: several tasks for each core, also where there are few bytes.

    A folder's file takes time, however small; told by bytes, one task would write
    all folders of a table with few rows in each.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    return _settings(
        spark,
        {
            "spark.sql.adaptive.coalescePartitions.minPartitionNum": str(tasks),
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        },
    )


def listing(spark: SparkSession) -> AbstractContextManager[None]:
    """For reading folders: lists many in each task, where by default each is a task of its own."""
    return _settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": "200"})


_SEPARATOR, _NULL = "\x1f", "\0"


def _write_lines(spark: SparkSession, path: str, lines: Iterable) -> None:
    """A small file of JSON lines."""
    store, at = _store(spark, path)
    out = store.create(at)
    out.write(bytearray("".join(f"{json.dumps(line)}\n" for line in lines).encode()))
    out.close()


def _read_lines(spark: SparkSession, path: str) -> list:
    store, at = _store(spark, path)
    if not store.exists(at):
        return []
    stream = store.open(at)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return [json.loads(line) for line in text.splitlines()]


def _text(values: Iterable[str | None]) -> str:
    return _SEPARATOR.join(_NULL if v is None else v for v in values)


def _text_of(columns: Sequence[str]) -> Column:
    """The text by which partitions and what runs covered are compared."""
    return F.concat_ws(_SEPARATOR, *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in columns])


def within(covered: Iterable[Spec]) -> Column:
    """Whether a row is in a part that one of ``covered`` names; by partition columns alone."""
    columns, specs = _same_columns(covered)
    if not columns:
        return F.lit(any(not spec for spec in specs))
    every = F.lit(any(not spec for spec in specs))
    return every | _text_of(columns).isin(sorted({_text(spec.values()) for spec in specs if spec}))


def _same_columns(covered: Iterable[Spec]) -> tuple[tuple[str, ...], list[dict]]:
    specs = [dict(spec) for spec in covered]
    columns = {tuple(spec) for spec in specs if spec}
    if len(columns) > 1:
        raise ValueError(f"parts are told by different columns, {sorted(columns)}")
    return (columns.pop() if columns else ()), specs


@dataclass(frozen=True)
class Snapshot:
    """A table as it was published at one moment; what is published later changes nothing."""

    spark: SparkSession
    path: str
    runs: tuple[str, ...] = ()
    #: columns that parts of the table are covered by
    columns: tuple[str, ...] = ()
    #: (run, values) of parts that a later run covers, and the first such run
    superseded: Mapping[tuple[str, tuple], str] = field(default_factory=dict)
    #: runs before one that covers the whole table
    old_runs: tuple[str, ...] = ()
    #: values of the parts that each run covers, () for the whole table
    parts: Mapping[str, frozenset[tuple]] = field(default_factory=dict)

    def holding(self, covered: Iterable[Spec]) -> "Snapshot":
        """Without the runs that have no row in a part that one of ``covered`` names."""
        columns, specs = _same_columns(covered)
        wanted = {tuple(spec.values()) for spec in specs}
        if () in wanted or (columns and self.columns and columns != self.columns):
            return self
        runs = [run for run in self.runs if () in self.parts[run] or self.parts[run] & wanted]
        return replace(self, runs=tuple(runs))

    def read(self, schema: StructType | None = None) -> DataFrame:
        """The rows, without the folders of superseded parts.

        ``schema``, with the partition columns, is needed where there may be no rows at
        all; with one, Spark reads no file to infer it.
        """
        if not self.runs:
            raise FileNotFoundError(f"{self.path} has no published run")
        reader = self.spark.read.option("basePath", self.path)
        if schema is not None:
            reader = reader.schema(StructType([*schema.fields]).add(RUN, "string"))
        with listing(self.spark):
            rows = reader.parquet(*[f"{self.path}/{RUN}={run}" for run in self.runs])
        if self.superseded:
            part = _text_of([RUN, *self.columns])
            rows = rows.where(~part.isin([_text((run, *values)) for run, values in sorted(self.superseded, key=str)]))
        return rows.drop(RUN)


def snapshot(spark: SparkSession, path: str) -> Snapshot:
    """What is published of a versioned table; no data file is listed.

    A small file is read for each run since the last that covered the whole table.
    """
    path = path.rstrip("/")
    runs = sorted(n.removeprefix(f"{RUN}=") for n in _children(spark, path) if n.startswith(f"{RUN}="))
    if not runs:
        return Snapshot(spark, path)
    covered: dict[str, list[dict]] = {}
    for run in reversed(runs):  # back to the last that covers all
        covered[run] = _read_lines(spark, f"{path}/{RUN}={run}/_covered")
        if {} in covered[run]:
            break
    first = runs.index(run)
    whole = [run] if {} in covered[run] else []
    columns, _ = _same_columns(spec for run in runs[first:] for spec in covered[run])
    covering: dict[tuple, list[str]] = {}
    for run in runs[first:]:
        for spec in covered[run]:
            if spec:
                found = covering.setdefault(tuple(spec.values()), [*whole])
                if run not in found:
                    found.append(run)
    stale = {(run, values): after for values, by in covering.items() for run, after in zip(by, by[1:], strict=False)}
    parts = {run: frozenset(tuple(spec.values()) for spec in covered[run]) for run in runs[first:]}
    return Snapshot(spark, path, tuple(runs[first:]), columns, stale, tuple(runs[:first]), parts)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """What a table holds now, be it in versions or plain Parquet folders."""
    state = snapshot(spark, path)
    if state.runs:
        return state.read(schema)
    with listing(spark):
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


class Version:
    """A run's partitions: written, but not part of the table until :meth:`publish`."""

    def __init__(
        self,
        rows: DataFrame,
        path: str,
        by: Sequence[str],
        covered: Iterable[Spec],
        sorted_by: Sequence[str] = (),
        few_rows: bool = False,
        together: Column | None = None,
    ):
        """``sorted_by``: each file is in order of these columns, so a filter on the first of
        them reads only the row groups whose range holds the value.

        ``few_rows``: no folder has many rows, as those of an aggregate. Then tasks are told by
        the number of folders, whose files take the time; by bytes, one task would write all.

        ``together``: rows that are alike in the columns ``covered`` names and in this go to one
        task.  It then makes the folders around theirs once, which takes about as long as a file.
        """
        self._spark, self._path, self._schema = rows.sparkSession, path.rstrip("/"), rows.schema
        columns, specs = _same_columns({c: spec[c] for c in by if c in spec} for spec in covered)
        if columns != tuple(by[: len(columns)]):
            raise ValueError(f"{path}: {columns} are not the first of its columns {list(by)}")
        plain = [n for n in _children(self._spark, self._path) if "=" in n and not n.startswith(f"{RUN}=")]
        if plain:
            raise ValueError(f"{path} holds partitions outside of any run, such as {plain[0]}")
        self._folder = f"{self._path}/_writing-{uuid.uuid4().hex}"
        try:
            if few_rows:
                most = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
                spread = rows.repartition(max(1, min(most, len(specs) if columns else most)), *by)
            elif together is not None:
                spread = rows.withColumn("__together", together).hint("rebalance", *columns, "__together").drop("__together")
            else:
                spread = rows.hint("rebalance", *by)
            if sorted_by:
                spread = spread.sortWithinPartitions(*by, *sorted_by)
            with spreading(self._spark):
                spread.write.partitionBy(*by).parquet(self._folder)
            self.note("covered", specs)
        except BaseException:
            self.discard()
            raise

    def read(self) -> DataFrame:
        """The rows as they are stored."""
        with listing(self._spark):
            return self._spark.read.schema(self._schema).parquet(self._folder)

    def values_of(self, column: str) -> set[str | None]:
        """Values, as text, of the partition column ``column``; folders tell them, no file is read."""
        value = F.regexp_extract("folder", f"/{column}=([^/]+)/", 1)
        found = folders_of(self.read()).select(value.alias("value")).distinct().collect()
        return {None if v == _NULL_FOLDER else unquote(unquote(v)) for (v,) in found if v}  # as URIs of escaped names

    def note(self, name: str, lines: Iterable) -> None:
        """Keep something small about the run, published with it and hidden from readers of its rows."""
        _write_lines(self._spark, f"{self._folder}/_{name}", lines)

    def publish(self) -> str:
        """Make the run part of the table, by one rename, and return its name."""
        run = f"v{datetime.now(timezone.utc).strftime(_TIME)}-{uuid.uuid4().hex[:8]}"
        store, at = _store(self._spark, self._folder)
        if not store.rename(at, _store(self._spark, f"{self._path}/{RUN}={run}")[1]):
            raise OSError(f"{self._folder} can't be renamed")
        return run

    def discard(self) -> None:
        store, at = _store(self._spark, self._folder)
        store.delete(at, True)


class Versions:
    """Versions of several tables that are published together."""

    def __init__(self) -> None:
        self.all: list[Version] = []

    def add(
        self,
        rows: DataFrame,
        path: str,
        by: Sequence[str],
        covered: Iterable[Spec],
        sorted_by: Sequence[str] = (),
        few_rows: bool = False,
        together: Column | None = None,
    ) -> Version:
        self.all.append(Version(rows, path, by, covered, sorted_by, few_rows, together))
        return self.all[-1]


@contextmanager
def written() -> Iterator[Versions]:
    """Publish the versions added in the block, one right after the other, when it ends.

    If it fails, none is published, and what was written is deleted.
    """
    versions = Versions()
    try:
        yield versions
    except BaseException:
        for version in versions.all:
            version.discard()
        raise
    for version in versions.all:
        version.publish()


def replace_partitions(
    rows: DataFrame,
    path: str,
    by: Sequence[str],
    covered: Iterable[Spec],
    sorted_by: Sequence[str] = (),
) -> str:
    """Replace all that the table holds of what ``covered`` names, in one step; see :class:`Version`.

    ``covered`` are values, as text, of the first of the columns ``by``: the files or dates that
    ``rows`` were made from, ``{}`` for all. A partition within them of which there are no
    rows any more is gone then; all others stay.
    """
    return Version(rows, path, by, covered, sorted_by).publish()


def notes(spark: SparkSession, path: str, name: str, runs: Iterable[str]) -> list:
    """What :meth:`Version.note` kept about these runs; nothing for runs without such a note."""
    return [line for run in runs for line in _read_lines(spark, f"{path.rstrip('/')}/{RUN}={run}/_{name}")]


def remove_superseded(spark: SparkSession, path: str, before: datetime) -> int:
    """Delete the folders that no reader needs who began after ``before``; returns how many.

    These are the parts that a run published before that time covers, and what runs left
    that stopped while writing, if it is as old. The table stays as it is.
    """
    state, limit = snapshot(spark, path), f"v{before.astimezone(timezone.utc).strftime(_TIME)}"
    folders = [f"{state.path}/{RUN}={run}" for run in state.old_runs if state.runs[0] < limit]
    for (run, values), after in state.superseded.items():
        if after < limit:
            names = [f"{c}={_NULL_FOLDER if v is None else v}" for c, v in zip(state.columns, values, strict=True)]
            folders.append("/".join([state.path, f"{RUN}={run}", *names]))
    for name in _children(spark, state.path):
        if name.startswith("_writing-"):
            store, at = _store(spark, f"{state.path}/{name}")
            if store.getFileStatus(at).getModificationTime() < before.timestamp() * 1000:
                folders.append(f"{state.path}/{name}")
    removed = 0
    for folder in folders:
        store, at = _store(spark, folder)
        removed += bool(store.exists(at) and store.delete(at, True))
    return removed
