"""Message files: one message per line, under ``<format>/<date>/<exchange>/``."""

import re
from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.sources.versions import folders_of, listing

# format, date and exchange folders of a message file; folders may also be
# written as name=value
_LAYOUT = r"/(?:[^/=]+=)?([^/=]+)/(?:[^/=]+=)?(\d{4}-\d{2}-\d{2})/(?:[^/=]+=)?([^/=]+)/[^/]+$"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Scan message files (S1, S2) into ``raw_line`` and the file's origin.

    ``paths`` may be files, folders or globs.  ``src_format``, ``src_date`` and
    ``src_exchange`` are NULL for a file outside the folder layout.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    with listing(spark):
        lines = reader.text([paths] if isinstance(paths, str) else list(paths))
    return lines.select(F.col("value").alias("raw_line"), *_origin(F.col("_metadata.file_path")))


def _origin(file_path: Column) -> list[Column]:
    # evaluated for each line: from the last four names alone, the pattern fits at once or not at all
    names = F.concat(F.lit("/"), F.substring_index(file_path, "/", -4))

    def part(group: int) -> Column:
        return F.nullif(F.regexp_extract(names, f"^{_LAYOUT}", group), F.lit(""))

    return [
        part(1).alias("src_format"),
        part(2).try_cast("date").alias("src_date"),
        part(3).alias("src_exchange"),
    ]


def no_lines(spark: SparkSession) -> DataFrame:
    """Lines of a format of which there are no files to read."""
    columns = "raw_line string, src_format string, src_date date, src_exchange string"
    return spark.createDataFrame([], columns)


def origins(spark: SparkSession, paths: str | Sequence[str]) -> list[dict[str, str | None]]:
    """The folders that message files lie in, those of empty files too; no file is read.

    Spark lists the files, many folders at a time; their names stay in the JVM, and only
    the distinct folders come here.
    """
    return origins_of(read_lines(spark, paths))


def origins_of(lines: DataFrame) -> list[dict[str, str | None]]:
    """:func:`origins` of what :func:`read_lines` found; nothing is listed again."""
    folders = folders_of(lines)
    found = {_origin_of(f"{unquote(row.folder)}x") for row in folders.collect()}
    return [dict(zip(("src_format", "src_date", "src_exchange"), one, strict=True)) for one in found]


def _origin_of(file: str) -> tuple[str | None, str | None, str | None]:
    match = re.search(_LAYOUT, file)
    if not match:
        return None, None, None
    try:
        day = date.fromisoformat(match[2]).isoformat()
    except ValueError:
        day = None
    return match[1], day, match[3]


def format_glob(root: str, message_format: str, day: str = "*", exchange: str = "*") -> str:
    """Glob of the message files of one format below ``root`` (S3)."""
    return f"{root.rstrip('/')}/{message_format}/{day}/{exchange}/*.txt"


def source_files(spark: SparkSession, root: str, message_format: str) -> DataFrame:
    """Line count of every message file of one format that has lines (S3)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(
        format_glob(root, message_format)
    )
    file_path = F.col("_metadata.file_path")
    return (
        lines.groupBy(file_path.alias("file_path"))
        .agg(F.count("*").alias("n_lines"))
        .select(
            "file_path",
            F.regexp_extract("file_path", _LAYOUT, 1).alias("src_format"),
            F.regexp_extract("file_path", _LAYOUT, 2).alias("src_date"),
            F.regexp_extract("file_path", _LAYOUT, 3).alias("src_exchange"),
            "n_lines",
        )
    )
