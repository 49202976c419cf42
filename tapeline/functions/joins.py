"""Joining one row per key back to the rows it was computed from."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(
    detail: DataFrame,
    per_key: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Add the columns of ``per_key`` (one row per ``keys``) to ``detail``.

    ``per_key`` usually comes out of an aggregation, already partitioned by the
    keys.  Spark would then join it without a shuffle of its own, and a join
    side without one is out of reach of AQE's skew handling.  The digest of the
    keys is a further join column that gives both sides their shuffle, so a hot
    key's detail rows are split over many tasks.  ``per_key`` is narrow, so its
    extra shuffle costs little beside the detail side.
    """
    names = {key: f"__{key}" for key in keys}
    values = [c for c in per_key.columns if c not in keys]
    right = per_key.select(
        *[F.col(key).alias(name) for key, name in names.items()],
        *values,
        F.xxhash64(*keys).alias("__digest"),
    )
    same = [
        F.col(key).eqNullSafe(F.col(name)) if null_safe else F.col(key) == F.col(name)
        for key, name in names.items()
    ]
    on = reduce(and_, same, F.xxhash64(*keys) == F.col("__digest"))
    return detail.join(right, on, how).select(*detail.columns, *values)
