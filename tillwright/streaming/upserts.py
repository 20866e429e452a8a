"""One row per key, kept up to date batch by batch, of which a batch rewrites only what it touches.

Rows lie in buckets of their key. A batch is reduced to one row per key, merged with the rows of its buckets, and the merged buckets
are written beside the old ones; a small file with the folder of every bucket, committed last, makes the batch count. Readers
take the newest such file, so they see whole batches only, and go on with the files they began with. A batch that is repeated after
its commit changes nothing; one that failed before it is done again.

A row is the greatest of its key's, as in :func:`tillwright.operators.dedup.one_row_per_key`: after any number of batches in
any order the rows are those of one pass over everything. Null keys are one key. With ids that grow with time give a bucket expression
of their range, then a batch touches the last buckets; hashed buckets spread any ids evenly.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwright.functions.numbers import ID
from tillwright.functions.text import PRODUCT_ID_PATTERN
from tillwright.operators.dedup import one_row_per_key
from tillwright.plans.curation import surviving_orders, valid_orders
from tillwright.session import stored
from tillwright.sources.parts import Parts
from tillwright.streaming.increments import survivor_schema

BUCKET = "bucket"


def hashed(buckets: int) -> Callable[[Column], Column]:
    """An even spread of any keys over so many buckets. Choose them so that a bucket has a few hundred MB."""
    return lambda key: F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def ranges(width: int) -> Callable[[Column], Column]:
    """Whole numbers by range: neighbours share a bucket, other keys the bucket -1."""
    return lambda key: F.coalesce(F.floor(key.try_cast("bigint") / width).cast("int"), F.lit(-1))


@dataclass(frozen=True)
class Upserts(Parts):
    """A folder of bucketed rows with key column ``key``; ``bucket`` must stay the same for the folder's life."""

    key: str
    bucket: Callable[[Column], Column] = hashed(64)

    def merge(self, spark: SparkSession, batch: int, rows: DataFrame) -> None:
        """Take in the rows of a batch; batches are numbered upwards."""
        if batch <= self.batch(spark):
            return
        bucketed = one_row_per_key(rows.select(*self.schema.names), [self.key]).withColumn(BUCKET, self.bucket(F.col(self.key)))
        arrived = stored(bucketed, "arrived")
        touched = sorted(row[0] for row in arrived.select(BUCKET).distinct().collect())
        paths = self.paths(spark)
        old = self.read(spark, [paths[str(n)] for n in touched if str(n) in paths])
        self.replace(spark, batch, self.merged(arrived, old.withColumn(BUCKET, self.bucket(F.col(self.key)))), BUCKET, touched, together=True)

    def merged(self, arrived: DataFrame, old: DataFrame) -> DataFrame:
        """One row per key of both, in the order of the buckets: rows are moved once for the merge and for the files.

        Both sides have a key once, so ranges of bucket and key are even whatever the buckets' sizes.
        """
        rows = arrived.unionByName(old).repartitionByRange(F.col(BUCKET), F.col(self.key))
        return one_row_per_key(rows, [BUCKET, self.key])


def order_upserts(spark: SparkSession, folder: str, id_type: str = ID, bucket: Callable[[Column], Column] = hashed(64)) -> Upserts:
    """A folder for the survivors of raw orders."""
    return Upserts(folder, survivor_schema(spark, id_type), "order_id", bucket)


def start_order_upserts(raw: DataFrame, into: Upserts, checkpoint: str, payment_names=None, id_type: str = ID, **trigger) -> StreamingQuery:
    """Merge every micro-batch of the raw order stream; the options are those of :func:`curation.parse_orders`."""

    def keep(rows: DataFrame, batch: int) -> None:
        into.merge(rows.sparkSession, batch, surviving_orders(rows, payment_names, id_type))

    writer = raw.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def upserted_orders(spark: SparkSession, into: Upserts, statuses=None, id_pattern: str = PRODUCT_ID_PATTERN) -> DataFrame:
    """The clean orders of all batches so far. Keys are single already, so nothing is merged when it is read."""
    return valid_orders(into.rows(spark), statuses, id_pattern)
