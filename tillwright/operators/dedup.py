"""One row per key, the same one on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep, for every key, the greatest row (columns compared in order, NULL lowest).

    NULL counts as one key value. As a maximum the choice does not depend on the order or the
    partitioning of the rows, and the maximum of maxima is the maximum: every task first
    reduces its own rows, so a key with very many copies costs one row per task in the
    shuffle, and increments can be merged later with the same result.
    """
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return df.distinct()
    chosen = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_chosen"))
    return chosen.select(
        *[F.col(name) if name in keys else F.col("_chosen")[name].alias(name) for name in df.columns]
    )
