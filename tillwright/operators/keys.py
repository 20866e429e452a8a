"""Dense surrogate keys: 1..n in the order of a unique column, without a one-task window.

Rows are range-partitioned and sorted; a row's key is the number of rows in earlier partitions plus
its place in its own. Only the partition counts ever meet in one task, whatever the type of the
column and however sparse its values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillwright.session import stored

# ``monotonically_increasing_id`` has the place within the partition in its lower 33 bits.
PLACE_BITS = 33


def dense_key(df: DataFrame, by: str, name: str) -> DataFrame:
    """Put column ``name`` in front: the place of the row in the order of ``by``, NULL first.

    Range partitioning samples its bounds, so the numbered rows are stored first: counts and
    keys then see the same partitions.
    """
    numbered = (
        df.repartitionByRange(F.col(by))
        .sortWithinPartitions(by)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_row", PLACE_BITS))
    )
    fixed = stored(numbered, f"dense-{name}")
    place = F.col("_row").bitwiseAND((1 << PLACE_BITS) - 1)
    return fixed.join(rows_before(fixed), "_slice").select((F.col("_before") + place + 1).alias(name), *df.columns)


def rows_before(numbered: DataFrame) -> DataFrame:
    """Number of rows in earlier partitions. One row per partition, hence the plain window."""
    counts = numbered.groupBy("_slice").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_slice", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))


def stable_key(df: DataFrame, by: str, name: str, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Put column ``name`` in front, keys of earlier runs staying as they are; also returns all keys given so far.

    ``known`` has ``by`` and ``name`` for every value that ever had a key, also those ``df`` no longer has: a key is never
    used again. Values without one are numbered in their order behind the greatest key, so the first run gives 1..n. NULL is
    one value. Only new values are range-partitioned and numbered.
    """
    given = known.select(F.col(by).alias("_by"), F.col(name).alias("_key"))
    same = F.col(by).eqNullSafe(F.col("_by"))
    new = dense_key(df.join(given, same, "left_anti").select(by).distinct(), by, name)
    # one number; an empty table has no greatest key
    greatest = known.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("greatest")).first()["greatest"]
    every = known.select(by, F.col(name).cast("bigint").alias(name)).union(new.select(by, (F.col(name) + greatest).alias(name)))
    every = stored(every, f"stable-{name}")
    keys = every.select(F.col(by).alias("_by"), F.col(name).alias("_key"))
    return df.join(keys, same).select(F.col("_key").alias(name), *df.columns), every
