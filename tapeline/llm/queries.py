"""Registered queries of the operators: whole tables, production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.llm import (
    ann,
    bpe,
    chats,
    packing,
    pii,
    quality,
    resampling,
    simhash,
    substrings,
    token_files,
    url_rules,
    warc,
    whitening,
)
from tapeline.llm.common import table
from tapeline.sources.staging import staging_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: cuts texts just where PATTERN does, but has fewer branches to try at each place
SCAN_PATTERN = r" ?(?:\p{L}+|\p{N}+)|'(?:[sdmt]|ll|ve|re)| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s"
QUERY_STEP = 50
NEIGHBOURS = 5


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, SCAN_PATTERN, added_tokens=True)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    asks = F.col("vec_id") % QUERY_STEP == 0
    return ann.nearest(table(spark, sf_dir, "embeddings"), asks, NEIGHBOURS)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    verdicts = quality.quality_verdicts(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return verdicts.select("doc_id", *quality.COUNTS, "base_failed", "kept", "lang", *quality.SHARES)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    counts = [count(kind) for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op5_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chats.maximal_conversations(table(spark, sf_dir, "conversations"))
    return chats.rendered(turns).select("conv_id", "position", "n_turns", "n_logged", "rendered")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    return bpe.decode(encoded, RANKS, PATTERN).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    return substrings.without_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(text, 256).alias("kept_sha256")
    )


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    fingerprint = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", fingerprint.alias("fingerprint"), "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whitened(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = resampling.importance_ranks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = token_files.write_token_files(docs, staging_path(spark, "files"), VOCABULARY, SCAN_PATTERN)
    return token_files.read_token_files(files).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_nearest,
        op3_quality,
        op4_pii,
        op5_chats,
        op6_bpe,
        op7_warc,
        op8_substrings,
        op9_urls,
        op10_simhash,
        op11_whitening,
        op12_resampling,
        op13_token_files,
    )
}
