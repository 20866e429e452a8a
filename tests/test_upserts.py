"""Bucketed upserts and keys that outlive rebuilds."""

import random
import re

import pytest
from fixture_files import write_shop
from pyspark.sql import functions as F

from tillwright.operators.dedup import one_row_per_key
from tillwright.operators.keys import stable_key
from tillwright.plans import build, curation
from tillwright.sources import files, parts
from tillwright.streaming import upserts

SCHEMA = "id string, a int, b string"


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture
def into(spark, tmp_path):
    return upserts.Upserts(str(tmp_path / "store"), spark.createDataFrame([], SCHEMA).schema, "id", upserts.ranges(10))


def test_batches_in_any_order_give_what_one_pass_gives(spark, tmp_path):
    draw = random.Random(2)
    rows = [(draw.choice([None, "x", *map(str, range(40))]), draw.choice([None, *range(5)]), draw.choice("pq")) for _ in range(200)]
    for number, bucket in enumerate((upserts.hashed(5), upserts.ranges(10))):
        store = upserts.Upserts(str(tmp_path / f"s{number}"), spark.createDataFrame([], SCHEMA).schema, "id", bucket)
        assert store.rows(spark).collect() == [] and store.batch(spark) == -1
        for batch in range(4):
            store.merge(spark, batch, spark.createDataFrame(rows[batch::4], SCHEMA))
        assert rows_of(store.rows(spark)) == rows_of(one_row_per_key(spark.createDataFrame(rows, SCHEMA), ["id"]))
        store.merge(spark, 4, spark.createDataFrame([], SCHEMA))
        assert store.batch(spark) == 4


def test_a_batch_rewrites_only_its_buckets(spark, into):
    into.merge(spark, 0, spark.createDataFrame([("1", 1, "a"), ("2", 1, "a"), ("15", 1, "a"), ("25", 1, "a")], SCHEMA))
    first = into.paths(spark)
    early = into.rows(spark)
    into.merge(spark, 1, spark.createDataFrame([("15", 2, "a"), ("16", 2, "a"), ("99", 0, "z")], SCHEMA))
    second = into.paths(spark)
    assert sorted(second) == ["0", "1", "2", "9"] and second["0"] == first["0"] and second["2"] == first["2"] and second["1"] != first["1"]
    assert [row["a"] for row in into.rows(spark).filter("id = '15'").collect()] == [2]
    assert rows_of(early) == rows_of(spark.createDataFrame([("1", 1, "a"), ("2", 1, "a"), ("15", 1, "a"), ("25", 1, "a")], SCHEMA))
    gone = into.remove_replaced(spark)
    assert len(gone) == 1 and gone[0].endswith("/bucket=1") and into.rows(spark).count() == 6


def test_a_merge_moves_rows_once(spark, into):
    rows = spark.createDataFrame([("1", 1, "a"), (None, 1, "a"), ("15", 1, "a")], SCHEMA).withColumn(upserts.BUCKET, into.bucket(F.col("id")))
    newer = rows.withColumn("a", F.lit(2))
    merged = into.merged(newer, rows)
    assert len(re.findall(r"Exchange \w+partitioning", merged._jdf.queryExecution().executedPlan().toString())) == 1
    assert rows_of(merged.select(*newer.columns)) == rows_of(newer)


def test_a_repeated_batch_changes_nothing(spark, into, monkeypatch):
    into.merge(spark, 0, spark.createDataFrame([("1", 1, "a")], SCHEMA))
    before = into.paths(spark)
    into.merge(spark, 0, spark.createDataFrame([("1", 9, "b"), ("50", 9, "b")], SCHEMA))
    assert into.paths(spark) == before and into.rows(spark).count() == 1
    # a batch that fails before its commit doesn't count, and is done again
    monkeypatch.setattr(parts, "commit_text", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        into.merge(spark, 1, spark.createDataFrame([("1", 9, "b")], SCHEMA))
    assert into.paths(spark) == before and [row["a"] for row in into.rows(spark).collect()] == [1]
    monkeypatch.undo()
    into.merge(spark, 1, spark.createDataFrame([("1", 9, "b")], SCHEMA))
    assert [row["a"] for row in into.rows(spark).collect()] == [9]


def test_a_stream_of_orders(spark, tmp_path):
    folder = write_shop(tmp_path)
    raw = files.read_orders(spark, f"{folder}/orders.csv")
    raw.repartition(3).write.parquet(str(tmp_path / "raw"))
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "raw"))
    into = upserts.order_upserts(spark, str(tmp_path / "store"), bucket=upserts.hashed(3))
    for _ in range(2):  # the second run has nothing new
        upserts.start_order_upserts(stream, into, str(tmp_path / "progress")).awaitTermination()
    assert into.batch(spark) == 2
    assert rows_of(upserts.upserted_orders(spark, into)) == rows_of(curation.clean_orders(raw))


def test_stable_keys(spark):
    first = spark.createDataFrame([("b", 1), ("d", 2), (None, 3), ("gone", 7)], "id string, k int")
    now = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), (None, 4.0), ("d", 5.0)], "id string, v double")
    keyed, every = stable_key(now, "id", "k", first)
    assert sorted(map(tuple, keyed.collect()), key=repr) == [(1, "b", 2.0), (2, "d", 5.0), (3, None, 4.0), (8, "a", 1.0), (9, "c", 3.0)]
    assert {row["id"]: row["k"] for row in every.collect()} == {"b": 1, "d": 2, None: 3, "gone": 7, "a": 8, "c": 9}
    fresh, _ = stable_key(now.filter("id > 'a'"), "id", "k", first.limit(0))
    assert sorted((row["k"], row["id"]) for row in fresh.collect()) == [(1, "b"), (2, "c"), (3, "d")]


def test_a_rebuild_keeps_every_key(spark, tmp_path):
    folder = write_shop(tmp_path)
    customers, products, orders = files.read_customers(spark, f"{folder}/customers.csv"), files.read_products(spark, f"{folder}/products.csv"), files.read_orders(spark, f"{folder}/orders.csv")
    names = ("keys_curated", "keys_gold")
    build.build(spark, customers.filter("customer_id <> 1"), products, orders, *names, stable_keys=True)
    before = {row["customer_id"]: row["customer_key"] for row in spark.table("keys_gold.dim_customer").collect()}
    _, gold = build.build(spark, customers, products, orders, *names, stable_keys=True)
    after = {row["customer_id"]: row["customer_key"] for row in gold["dim_customer"].collect()}
    assert before == {2: 1, 3: 2} and after == {1: 3, 2: 1, 3: 2}
    assert gold["fact_sales"].filter("customer_key is null").isEmpty()
    assert {row["product_key"] for row in gold["dim_product"].collect()} == {1, 2, 3}
