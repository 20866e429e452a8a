"""Table operators against plain restatements, also with one key holding a large share of rows."""

import random

import pytest
from pyspark.sql import Window, functions as F

from tillwright.operators.checks import (
    BadRows, KnownKey, SameTotal, UniqueKey, duplicate_keys, enforce, key_profile, report, row_counts, side_by_side,
)
from tillwright.operators.dedup import one_row_per_key
from tillwright.operators.keys import dense_key, rows_before
from tillwright.operators.ranking import ranked, top
from tillwright.operators.references import keep_referenced, orphan_keys, with_attributes, with_surrogate


@pytest.fixture(scope="module")
def rows():
    """A third of the rows share one key, some keys are NULL."""
    rng = random.Random(3)
    keys = ["hot"] * 700 + [None] * 100 + [f"k{rng.randint(0, 400)}" for _ in range(1300)]
    return [(key, rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.random() < 0.5) for key in keys]


SCHEMA = "key string, n int, t string, flag boolean"


def low_null(value):
    return (value is not None, value if value is not None else 0)


def test_one_row_per_key_is_the_greatest_row(spark, rows):
    expected = {}
    for key, n, t, flag in rows:
        order = (low_null(n), (t is not None, t or ""), flag)
        if key not in expected or order > expected[key][0]:
            expected[key] = (order, (key, n, t, flag))
    wanted = {value for _, value in expected.values()}
    df = spark.createDataFrame(rows, SCHEMA)
    for partitions in (1, 7):
        shuffled = df.repartition(partitions, F.rand(partitions))
        assert {tuple(row) for row in one_row_per_key(shuffled, ["key"]).collect()} == wanted


def test_one_row_per_key_merges(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    left, right = (one_row_per_key(df.filter(condition), ["key"]) for condition in ("n is null or n < 2", "n >= 2"))
    assert sorted(map(repr, one_row_per_key(left.union(right), ["key"]).collect())) == sorted(
        map(repr, one_row_per_key(df, ["key"]).collect())
    )


def test_one_row_per_key_of_keys_only(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "key string")
    assert sorted(map(repr, one_row_per_key(df, ["key"]).collect())) == ["Row(key='a')", "Row(key=None)"]


IDS = [0, 1, 5, 2**20 - 1, 2**20, 2**20 + 1, 2**21, 2**31 - 1, -1, -(2**20), -(2**20) - 1, -(2**31)]


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_dense_key_over_ids(spark, kind):
    rng = random.Random(5)
    ids = sorted(set(IDS + [rng.randint(-(2**31), 2**31 - 1) for _ in range(500)]))
    df = spark.createDataFrame([(i, str(i)) for i in random.Random(1).sample(ids, len(ids))], f"id {kind}, t string")
    keyed = dense_key(df, "id", "key")
    assert keyed.columns == ["key", "id", "t"]
    assert [(row.key, row.id) for row in keyed.orderBy("id").collect()] == list(enumerate(ids, 1))


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_dense_key_over_text(spark, partitions):
    rng = random.Random(partitions)
    names = sorted({f"{rng.choice('abP')}{rng.randint(0, 10**6)}" for _ in range(3000)} | {"", "é", "Z"}, key=lambda t: t.encode())
    df = spark.createDataFrame([(name,) for name in rng.sample(names, len(names))], "name string")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        keyed = dense_key(df, "name", "key").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted((row.key, row.name) for row in keyed) == list(enumerate(names, 1))


def test_dense_key_keeps_null_first(spark):
    for kind, values in (("bigint", [5, None, 2**40]), ("string", ["b", None, "c"])):
        rows = dense_key(spark.createDataFrame([(value,) for value in values], f"id {kind}"), "id", "key").collect()
        assert {row.id: row.key for row in rows} == dict(zip([None, values[0], values[2]], [1, 2, 3]))


def test_counts_of_sparse_ids_are_one_per_partition(spark):
    df = spark.range(20_000).select((F.col("id") * 461_168_601_842_738).alias("id")).repartition(8)
    keyed = dense_key(df, "id", "key")
    assert keyed.agg(F.min("key"), F.max("key"), F.count_distinct("key")).first() == (1, 20_000, 20_000)
    numbered = df.repartitionByRange("id").withColumn("_slice", F.spark_partition_id())
    assert rows_before(numbered).count() <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_dense_key_of_nothing(spark):
    for kind in ("int", "string"):
        assert dense_key(spark.createDataFrame([], f"id {kind}"), "id", "key").count() == 0


def test_dense_key_is_the_global_row_number(spark):
    df = spark.range(0, 3_000_000, 1000, 5).select(((F.col("id") * 7919) % 3_000_017).cast("int").alias("id"))
    plain = df.withColumn("plain", F.row_number().over(Window.orderBy("id")))
    joined = dense_key(df, "id", "key").join(plain, "id")
    assert joined.filter("key = plain").count() == df.count()


@pytest.fixture(scope="module")
def family(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d"), (None, "e"), (3, "f")], "id int, t string")
    parent = spark.createDataFrame([(1, 10, "x"), (2, 20, "y"), (4, 40, "z")], "id int, key int, t string")
    return child, parent


def test_references(family):
    child, parent = family
    assert sorted(row.t for row in keep_referenced(child, parent, "id").collect()) == ["a", "b", "c"]
    assert sorted(map(repr, orphan_keys(child, parent, "id").collect())) == ["Row(id=3)", "Row(id=None)"]
    looked_up = with_surrogate(child, parent, "id", "key")
    assert looked_up.columns == ["id", "t", "key"]
    assert sorted((row.t, row.key) for row in looked_up.collect()) == [
        ("a", 10), ("b", 20), ("c", 20), ("d", None), ("e", None), ("f", None),
    ]
    assert sorted(tuple(row) for row in with_attributes(child, parent, "id", ["t"]).collect()) == [(1, "x"), (2, "y"), (2, "y")]


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", None), ("d", 3)], "t string, m int")
    assert [row.t for row in ranked(df, "m", "t").collect()] == ["b", "d", "a", "c"]
    assert [row.t for row in top(df, "m", 2, "t").collect()] == ["b", "d"]


def test_report_finds_each_violation(family):
    child, parent = family
    checks = [
        BadRows("id is null", "child", F.col("id").isNull()),
        BadRows("t is late", "child", F.col("t") > "d"),
        BadRows("id is null", "parent", F.col("id").isNull()),
        UniqueKey("id repeats", "child", "id"),
        UniqueKey("id repeats", "parent", "id"),
        KnownKey("id unknown", "child", "id", "parent"),
        SameTotal("count differs", "child", "parent", F.count("*")),
        SameTotal("count agrees", "child", "child", F.count("*")),
    ]
    outcome = report({"child": child, "parent": parent}, checks)
    found = {(row.check_name, row.table_name): (row.failed_rows, row.passed) for row in outcome.collect()}
    assert found == {
        ("id is null", "child"): (1, False),
        ("t is late", "child"): (2, False),
        ("id is null", "parent"): (0, True),
        ("id repeats", "child"): (2, False),
        ("id repeats", "parent"): (0, True),
        ("id unknown", "child"): (2, False),
        ("count differs", "child"): (1, False),
        ("count agrees", "child"): (0, True),
    }
    with pytest.raises(ValueError, match=r"id repeats on child \(2\)"):
        enforce(outcome)
    enforce(outcome.filter("passed"))


def test_key_profile_counts_tables_of_one_domain_only(spark):
    """Rows of the profile have as many counts as one domain has tables, whatever the number of tables."""
    tables = {
        "a": spark.createDataFrame([(1, "x"), (1, "y"), (None, "x")], "id int, code string"),
        "b": spark.createDataFrame([(1,), (2,)], "id bigint"),
        "c": spark.createDataFrame([("x",), (None,)], "code string"),
        "d": spark.createDataFrame([(7,), (7,)], "other int"),
    }
    found = key_profile(tables, [("a", "id"), ("b", "id"), ("a", "code"), ("c", "code"), ("d", "other"), ("a", "id")])
    assert found.columns == ["domain", "key", "a", "b", "c", "d"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        ("id", "1", 2, 1, 0, 0), ("id", None, 1, 0, 0, 0), ("id", "2", 0, 1, 0, 0),
        ("code", "x", 2, 0, 1, 0), ("code", "y", 1, 0, 0, 0), ("code", None, 0, 0, 1, 0), ("other", "7", 0, 0, 0, 2),
    ], key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    grouped = next(line for line in plan.splitlines() if "Aggregate [" in line)
    assert grouped.count("count(") == 2


def test_counts_and_totals(family):
    child, parent = family
    assert {tuple(row) for row in row_counts({"c": child, "p": parent}).collect()} == {("c", 6), ("p", 3)}
    assert tuple(side_by_side(child, parent, F.sum("id"), "l", "r").first()) == (11, 7)
    assert {tuple(row) for row in duplicate_keys(child, "id").collect()} == {(2, 2), (3, 2)}
