"""Joins along foreign keys.

No broadcast hints: Spark broadcasts a side when its measured size is under the configured
limit, and splits skewed partitions of the sort-merge joins it uses otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def keep_referenced(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists in ``parent``; only the key column of ``parent`` is read."""
    return df.join(parent.select(key), key, "left_semi").select(*df.columns)


def orphan_keys(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """The distinct key values of ``df`` that ``parent`` lacks; NULL counts as lacking.

    The keys are made distinct before the join, which leaves a hot key one row to move.
    """
    return df.select(key).distinct().join(parent.select(key), key, "left_anti")


def with_surrogate(df: DataFrame, dimension: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Add the surrogate key of ``dimension``; rows without a match get NULL and stay."""
    return df.join(dimension.select(natural, surrogate), natural, "left").select(*df.columns, surrogate)


def with_attributes(df: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Add attributes of ``dimension``, replacing columns of the same name; rows without a match go."""
    return df.drop(*attributes).join(dimension.select(key, *attributes), key, "inner")
