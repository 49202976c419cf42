"""The corpus pipeline: rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the ``docs`` of the next; all but the last return the columns of
documents. ``run`` applies them to the whole documents table.

An empty table stays empty in every stage. A null text counts as an empty one: the rules reject
it, and where it gets further it stays null and is packed as its end token. Repeated rows are
documents of their own until near-duplicates go; other columns are kept, whatever they are called.
A very long text is worked on in one task at a time.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import packing, pii, quality, simhash, substrings
from tapeline.llm.common import fresh, stage, table
from tapeline.llm.queries import SCAN_PATTERN, VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    labels = table(spark, sf_dir, "labels")
    return _with_own_names(docs, quality.RESULTS, lambda d: quality.quality_verdicts(d, labels).filter("kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return simhash.one_per_group(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words in windows that start earlier in the corpus go; the layout of the rest stays."""
    return _with_own_names(
        docs, substrings.RESULTS, lambda d: _measured(substrings.without_repeats(d, keep_layout=True))
    )


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers, plain or disguised, are replaced by their kind."""
    return _measured(pii.masked(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens, a row per piece of a document."""
    return packing.pack(docs, VOCABULARY, SCAN_PATTERN, added_tokens=True)


def _with_own_names(docs: DataFrame, results: Sequence[str], function: Callable) -> DataFrame:
    """``function(docs)`` with the columns of ``docs``, even those named like a result."""
    names = {c: fresh(docs, f"_own_{c}") if c.lower() in results else c for c in docs.columns}
    rows = function(docs.withColumnsRenamed(names))
    return rows.select([F.col(name).alias(c) for c, name in names.items()])


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("PII", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, function) in enumerate(STAGES, 1):
        docs = function(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage(docs, f"pipeline-{number}")
    return docs


#: SQL has neither the tokenizer nor the transducers; tests hold run() against brute force
ORACLE_SQL = None
