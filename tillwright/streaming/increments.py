"""Orders as a stream.

Every micro-batch is parsed, reduced to one row per order id and stored in a folder of its own. The
survivor of an order id is a maximum, so reducing the stored survivors again gives exactly what
one batch over all rows would give, whatever the order of arrival.

A micro-batch that is repeated after a failure replaces its own folder with the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillwright.functions.numbers import ID
from tillwright.functions.text import PRODUCT_ID_PATTERN
from tillwright.operators.dedup import one_row_per_key
from tillwright.plans.curation import surviving_orders, valid_orders
from tillwright.session import folder_exists, scratch_path
from tillwright.sources import schemas

BATCH = "batch"


def start_increments(
    raw: DataFrame, folder: str, checkpoint: str, payment_names=None, id_type: str = ID, **trigger
) -> StreamingQuery:
    """Store the survivors of every micro-batch of the raw order stream under ``folder``.

    ``payment_names`` and ``id_type`` are those of :func:`curation.parse_orders`.
    """

    def keep(rows: DataFrame, batch: int) -> None:
        surviving_orders(rows, payment_names, id_type).write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch}")

    writer = raw.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def survivor_schema(spark: SparkSession, id_type: str) -> StructType:
    """Columns and types of the stored survivors, known also before the first batch."""
    nothing = spark.createDataFrame([], schemas.ORDERS_RAW)
    return surviving_orders(nothing, None, id_type).schema


def merged_survivors(spark: SparkSession, folder: str, id_type: str = ID) -> DataFrame:
    """One row per order id over all stored micro-batches; no rows before the first batch."""
    stored = spark.read.schema(survivor_schema(spark, id_type)).option("recursiveFileLookup", "true")
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], survivor_schema(spark, id_type))
    return one_row_per_key(stored.parquet(folder), ["order_id"])


def compact(spark: SparkSession, folder: str, into: str, id_type: str = ID) -> None:
    """Reduce what has arrived to one batch in the new folder ``into``, to be read instead of ``folder``."""
    merged_survivors(spark, folder, id_type).write.parquet(f"{into}/{BATCH}=0")


def merged_orders(
    spark: SparkSession, folder: str, statuses=None, id_type: str = ID, id_pattern: str = PRODUCT_ID_PATTERN
) -> DataFrame:
    """The clean orders of everything that has arrived so far, with the options of :func:`curation.clean_orders`."""
    return valid_orders(merged_survivors(spark, folder, id_type), statuses, id_pattern)


def curate_available(
    raw: DataFrame, payment_names=None, statuses=None, id_type: str = ID, id_pattern: str = PRODUCT_ID_PATTERN
) -> DataFrame:
    """Take in all that the stream has now and return the clean orders."""
    spark = raw.sparkSession
    folder = scratch_path(spark, "order-increments")
    start_increments(raw, folder, scratch_path(spark, "order-progress"), payment_names, id_type).awaitTermination()
    return merged_orders(spark, folder, statuses, id_type, id_pattern)


def first_arrivals(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """One row per key for an append sink; a repeat later than ``delay`` is a new row.

    State is bounded by the watermark. Which of several copies stays depends on arrival, so
    this is for exact repeats; conflicting copies need the stored survivors above.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)
