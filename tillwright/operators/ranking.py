"""Ordered reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ranked(df: DataFrame, metric: str, *ties: str) -> DataFrame:
    """Rows by ``metric`` from high to low, NULL last, then by ``ties``."""
    return df.orderBy(F.desc_nulls_last(metric), *[F.asc_nulls_first(column) for column in ties])


def top(df: DataFrame, metric: str, count: int, *ties: str) -> DataFrame:
    """The first ``count`` rows of :func:`ranked`; each task keeps only that many."""
    return ranked(df, metric, *ties).limit(count)
