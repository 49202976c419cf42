"""Trades, quotes and message lines derived from the ``events`` table.

There is no market table among the given ones, so every event stands for a
message: purchases and clicks for trades, views and signups for quotes, errors
for messages of an unknown type.  Every tenth event has a corrected version
that arrives five seconds later.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeline.schemas import PRICE


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of all messages, of every type."""
    kind = F.col("event_type")
    rec_type = (
        F.when(kind.isin("purchase", "click"), "T").when(kind.isin("view", "signup"), "Q")
    ).otherwise("X")
    versions = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    price = (F.col("value").cast(PRICE) + F.col("version")).cast(PRICE)
    return (
        events(spark, sf_dir)
        .withColumn("version", F.explode(versions))
        .select(
            F.col("ts").cast("date").alias("trade_dt"),
            rec_type.alias("rec_type"),
            F.concat(F.lit("S"), (F.col("user_id") % 4).cast("string")).alias("symbol"),
            F.when(F.col("event_id") % 2 == 0, "NYSE").otherwise("NASDAQ").alias("exchange"),
            F.col("ts").alias("event_tm"),
            F.col("event_id").alias("event_seq_nb"),
            (
                F.col("ts")
                + F.when(F.col("version") == 1, F.expr("INTERVAL '6' SECOND")).otherwise(
                    F.expr("INTERVAL '1' SECOND")
                )
            ).alias("arrival_tm"),
            price.alias("px"),
            (F.col("event_id") % 100).alias("sz"),
        )
    )


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_messages(spark, sf_dir)
        .where("rec_type = 'T'")
        .withColumnsRenamed({"px": "trade_pr", "sz": "bid_size"})
        .drop("rec_type")
    )


def raw_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_messages(spark, sf_dir)
        .where("rec_type = 'Q'")
        .withColumn("ask_pr", (F.col("px") + F.lit(0.05).cast("decimal(3,2)")).cast(PRICE))
        .withColumn("ask_size", F.col("sz") + 1)
        .withColumnsRenamed({"px": "bid_pr", "sz": "bid_size"})
        .drop("rec_type")
    )


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _sizes() -> list[Column]:
    ask_pr = (F.col("px") + F.lit(0.05).cast("decimal(3,2)")).cast(PRICE)
    return [_text("sz"), ask_pr.cast("string"), (F.col("sz") + 1).cast("string")]


def csv_lines(messages: DataFrame, *extra: str) -> DataFrame:
    """One CSV line per message, after any ``extra`` columns.

    Some lines are faulty by design, told by the sequence number: every 46th
    lacks its last field, every 74th is empty, every 58th has no proper price.
    """
    seq = F.col("event_seq_nb")
    price = F.when(seq % 58 == 0, "n/a").otherwise(_text("px"))
    head = [
        _text("trade_dt"),
        _text("arrival_tm"),
        F.col("rec_type"),
        F.col("symbol"),
        _text("event_tm"),
        _text("event_seq_nb"),
        F.col("exchange"),
        price,
    ]
    size, ask_pr, ask_size = _sizes()
    quote = F.col("rec_type") == "Q"
    short = seq % 46 == 0
    line = (
        F.when(quote & short, F.concat_ws(",", *head, size, ask_pr))
        .when(quote, F.concat_ws(",", *head, size, ask_pr, ask_size))
        .when(short, F.concat_ws(",", *head))
        .otherwise(F.concat_ws(",", *head, size))
    )
    return messages.select(*extra, F.when(seq % 74 == 0, "").otherwise(line).alias("raw_line"))


def json_lines(messages: DataFrame, *extra: str) -> DataFrame:
    """One JSON line per message, after any ``extra`` columns.

    Some lines are faulty by design, told by the sequence number: every 51st
    lacks a needed name, every 69th is cut short, every 57th quote has the bid
    price null, which is allowed.
    """
    seq = F.col("event_seq_nb")
    size, ask_pr, ask_size = _sizes()
    missing = seq % 51 == 0
    trade, quote = F.col("rec_type") == "T", F.col("rec_type") == "Q"

    common = [
        _text("trade_dt").alias("trade_dt"),
        F.col("rec_type").alias("event_type"),
        F.col("symbol"),
        F.col("exchange"),
        _text("event_tm").alias("event_tm"),
        F.when(~(quote & missing), seq).alias("event_seq_nb"),
        _text("arrival_tm").alias("file_tm"),
        F.when(trade & ~missing, F.concat(F.lit("x"), _text("event_seq_nb"))).alias("execution_id"),
        F.when(~quote, _text("px")).alias("price"),
        F.when(~quote, F.col("sz")).alias("size"),
        F.when(quote, size).alias("bid_size"),
        F.when(quote, ask_pr).alias("ask_pr"),
        F.when(quote, ask_size).alias("ask_size"),
        F.when(quote & (seq % 57 != 0), _text("px")).alias("bid_pr"),
    ]
    null_bid = F.concat(F.lit('{"bid_pr":null,'), F.expr("substring(line, 2)"))
    cut = F.expr("substring(line, 1, length(line) - 12)")
    return (
        messages.withColumn("line", F.to_json(F.struct(*common)))
        .withColumn("line", F.when(quote & (seq % 57 == 0), null_bid).otherwise(F.col("line")))
        .select(*extra, F.when(seq % 69 == 0, cut).otherwise(F.col("line")).alias("raw_line"))
    )


def split_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """CSV lines of one exchange's messages and JSON lines of the other's."""
    messages = raw_messages(spark, sf_dir)
    return (
        csv_lines(messages.where("exchange = 'NYSE'")),
        json_lines(messages.where("exchange = 'NASDAQ'")),
    )
