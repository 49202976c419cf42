"""Cumulative chat logs collapsed to maximal conversations, then rendered."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeline.llm.common import stage

CHUNK_TURNS = 1024
_CONTENT = ("p", "q")  # two 64-bit hashes stand for a turn's role and text
_HASHES = ("x", "y")  # and two are the key of a prefix
_TURN = ["conv_id", "turn", *_CONTENT]


def _tie_ranks(turns: DataFrame, narrow: DataFrame) -> DataFrame:
    """(conv_id, turn, p, q, tie): the order by role and text of turns of equal number.

    Only these need their texts for it. Both tables are written, so that the planner
    knows their sizes and broadcasts them only if they are small, as they mostly are.
    """
    ties = narrow.groupBy("conv_id", "turn").count().filter("count > 1").drop("count")
    tied = turns.join(stage(ties, "ties"), ["conv_id", "turn"], "left_semi").dropDuplicates(_TURN)
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return stage(tied.select(*_TURN, F.row_number().over(order).alias("tie")), "tie-ranks")


def prefix_keys(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns in their places, and the keys of the prefixes that they end.

    ``turns`` is (conv_id, turn, role, text, p, q). The places are (conv_id, turn, p, q,
    position, n_turns) without repeats, the keys (conv_id, position, n_turns, x, y),
    where x and y identify all turns so far. No text is shuffled for either.

    Each turn is hashed with its position, and the hashes are rolled up by exclusive
    or, so that a prefix can be put together from parts: turns are numbered within
    chunks of CHUNK_TURNS turn numbers first, then chunks are added up. No task holds a
    whole conversation at once, however long.
    """
    narrow = stage(turns.select(_TURN).distinct(), "turns")
    chunk = F.floor(F.col("turn") / CHUNK_TURNS)
    of_chunk = ["conv_id", "chunk"]
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = narrow.groupBy("conv_id", chunk.alias("chunk")).agg(F.count("*").alias("n"))
    starts = sizes.select(
        *of_chunk,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("skip"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    rows = narrow.join(_tie_ranks(turns, narrow), _TURN, "left").withColumn("chunk", chunk)
    at = F.row_number().over(Window.partitionBy(*of_chunk).orderBy("turn", "tie"))
    rows = rows.withColumn("at", at).join(starts, of_chunk)
    rows = rows.withColumn("position", F.col("skip") + F.col("at"))
    parts = {h: F.xxhash64(F.lit(h), "position", *_CONTENT) for h in _HASHES}
    so_far = Window.partitionBy(*of_chunk).orderBy("position")
    rows = rows.withColumns({h: F.bit_xor(part).over(so_far) for h, part in parts.items()})
    rows = stage(rows.select(*_TURN, "chunk", "position", "n_turns", *_HASHES), "places")

    whole = rows.groupBy(*of_chunk).agg(*[F.max_by(h, "position").alias(h) for h in _HASHES])
    before = [F.coalesce(F.bit_xor(h).over(earlier), F.lit(0)).alias(f"{h}_before") for h in _HASHES]
    keys = rows.join(whole.select(*of_chunk, *before), of_chunk).select(
        "conv_id", "position", "n_turns", *[F.col(h).bitwiseXOR(F.col(f"{h}_before")).alias(h) for h in _HASHES]
    )
    return rows.select(*_TURN, "position", "n_turns"), keys


def maximal_conversations(conversations: DataFrame) -> DataFrame:
    """The turns of conversations that are no prefix of another, each logged once.

    ``conversations`` is (conv_id, turn, role, text), a row a turn; other columns are
    left out. Turns are ordered by number, those of equal number by role and text; a
    row that repeats another counts once. Null role and text count as empty; rows
    without conv_id or turn belong to no conversation and are left out. Of
    conversations with equal turns the one with the smallest id stays. Returns
    conv_id, turn, role, text, position (from 1), n_turns and n_logged, the number of
    logged conversations with these turns. Texts are shuffled once, at the end.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")],
    )
    turns = turns.filter("conv_id is not null and turn is not null")
    turns = turns.withColumns({h: F.xxhash64(F.lit(h), "role", "text") for h in _CONTENT})
    places, keys = prefix_keys(turns)
    key = ["position", *_HASHES]
    whole = keys.filter("position = n_turns").groupBy(*key).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged")
    )
    begun = keys.filter("position < n_turns").select(*key).distinct()
    kept = stage(whole.join(begun, key, "left_anti").select("conv_id", "n_logged"), "maximal")
    return turns.dropDuplicates(_TURN).join(places.join(kept, "conv_id"), _TURN).select(
        "conv_id", "turn", "role", "text", "position", "n_turns", "n_logged"
    )


def rendered(turns: DataFrame) -> DataFrame:
    """``turns`` with ``rendered``: the turn as chat text, a header line and an end mark.

    The rendered turns of a conversation, put together in order of position, are its
    chat text; they are rows of their own, so that a long conversation is not one row.
    """
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")))
