"""Tables replaced by a switch: readers, failing checks, failing publications, other columns, old versions."""

import re

import pytest
from fixture_files import write_shop
from pyspark.sql import functions as F

from tillwright.plans import build, curation, views
from tillwright.sources import files, tables, versions


@pytest.fixture
def namespace(spark, tmp_path):
    name = f"ns_{abs(hash(str(tmp_path)))}"
    tables.ensure_namespace(spark, name, str(tmp_path / "tables"))
    return name


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    folder = str(write_shop(tmp_path_factory.mktemp("shop")))
    return files.read_customers(spark, f"{folder}/customers.csv"), files.read_products(spark, f"{folder}/products.csv"), files.read_orders(spark, f"{folder}/orders.csv")


def ids(df):
    return sorted(row[0] for row in df.select("id").collect())


def test_a_reader_that_began_before_the_switch_ends_right(spark, namespace):
    name = f"{namespace}.t"
    tables.save_table(spark.range(3), name)
    early = spark.table(name)
    tables.save_table(spark.range(10, 15), name)
    assert ids(early) == [0, 1, 2] and ids(spark.table(name)) == [10, 11, 12, 13, 14]
    assert ids(spark.newSession().table(name)) == [10, 11, 12, 13, 14]
    tables.save_table(spark.table(name).filter("id > 12"), name)  # a table may be made from itself
    assert ids(spark.table(name)) == [13, 14]


def test_other_columns_and_partitions(spark, namespace):
    name = f"{namespace}.t"
    tables.save_table(spark.range(3), name)
    wider = spark.range(4).select((F.col("id") % 2).cast("int").alias("part"), "id", F.lit("it's").alias("note"))
    found = tables.save_table(wider, name, partition_by=["part"])
    assert sorted(found.columns) == ["id", "note", "part"] and ids(found.filter("part = 1")) == [1, 3]
    assert "PartitionFilters: [isnotnull(part" in found.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    tables.save_table(wider.filter("id < 2"), name, partition_by=["part"])
    assert ids(spark.table(name)) == [0, 1]
    assert not any(versions.INCOMING in entry for entry in tables.names_in(spark, namespace))


def test_a_failing_publication_changes_nothing(spark, namespace):
    names = [f"{namespace}.{name}" for name in ("a", "b", "v")]
    staging = versions.Staging(spark)
    staging.add(spark.range(2), names[0])
    staging.add_view(names[2], f"SELECT id FROM {names[0]}")
    staging.publish()
    places = versions.location_of(spark, names[0])
    second = versions.Staging(spark)
    second.add(spark.range(5).withColumn("more", F.lit(1)), names[0])
    second.add(spark.range(5), names[1])
    second.add_view(names[2], f"SELECT id + 1 AS id FROM {names[0]}")
    second.add_view(f"{namespace}.broken", "SELECT nothing FROM nowhere")
    with pytest.raises(Exception, match="nowhere"):
        second.publish()
    assert versions.location_of(spark, names[0]) == places and ids(spark.table(names[0])) == [0, 1]
    assert spark.table(names[0]).columns == ["id"] and ids(spark.table(names[2])) == [0, 1]
    assert tables.names_in(spark, namespace) == ["a", "v"]


def test_old_versions_go_when_told(spark, namespace):
    name = f"{namespace}.t"
    for n in range(1, 5):
        tables.save_table(spark.range(n), name)
    kept = versions.versions(spark, name)
    assert len(kept) == 4
    assert versions.remove_old_versions(spark, name, keep=1) == kept[:2]
    assert versions.versions(spark, name) == kept[2:] and ids(spark.table(name)) == [0, 1, 2, 3]
    assert versions.remove_old_versions(spark, name, keep=0) == kept[2:3]


def test_a_bad_path_leaves_the_mount(spark, namespace, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "good"))
    spark.range(4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(str(tmp_path / "parts"))
    alias = f"{namespace}.m"
    tables.mount(spark, alias, str(tmp_path / "good"))
    with pytest.raises(Exception):
        tables.mount(spark, alias, str(tmp_path / "nowhere")).collect()
    assert ids(spark.table(alias)) == [0, 1, 2]
    assert ids(tables.mount(spark, alias, str(tmp_path / "parts")).filter("k = 1")) == [1, 3]


def _state(spark, *namespaces):
    found = {}
    for namespace in namespaces:
        for name in tables.names_in(spark, namespace):
            full = f"{namespace}.{name}"
            found[full] = versions.location_of(spark, full), versions.view_text(spark, full), sorted(map(repr, spark.table(full).collect()))
    return found


def test_a_failing_check_leaves_all_tables_and_views(spark, shop, monkeypatch):
    names = ("kept_curated", "kept_gold")
    build.build(spark, *shop, *names)
    before = _state(spark, *names)
    monkeypatch.setattr(build.star, "sales_fact", lambda sold, *more, make=build.star.sales_fact: make(sold, *more).limit(1))
    with pytest.raises(ValueError, match="data-quality checks failed"):
        build.build(spark, shop[0], shop[1], shop[2].filter("order_id <> '102'"), *names)
    assert _state(spark, *names) == before
    monkeypatch.undo()
    build.build(spark, shop[0], shop[1], shop[2].filter("order_id <> '102'"), *names)
    assert _state(spark, *names) != before


def test_views_of_the_catalog_are_the_frames(spark, shop):
    _, gold = build.build(spark, *shop, "seen_curated", "seen_gold")
    frames, other = build.report_frames(gold), spark.newSession()
    assert set(views.view_queries("seen_gold")) == set(frames)
    for name, frame in frames.items():
        view = other.table(f"seen_gold.{name}")
        assert view.dtypes == frame.dtypes
        rows = sorted(map(repr, view.collect()))
        assert rows and rows == sorted(map(repr, frame.collect()))
    # a session that has the old version keeps it until it refreshes; others see what a later run shows
    build.build(spark, shop[0], shop[1], shop[2].filter("order_id <> '102'"), "seen_curated", "seen_gold")
    orders = gold["fact_sales"].select("order_id").distinct().count()
    assert other.table("seen_gold.vw_executive_kpis").first()["total_orders"] == orders
    other.catalog.refreshTable("seen_gold.fact_sales")
    for session in (other, spark, spark.newSession()):
        assert session.table("seen_gold.vw_executive_kpis").first()["total_orders"] == orders - 1


def test_stored_tables_and_views_move_little(spark, shop):
    """Stored tables are compressed by zstd; by product and day, orders are told apart as pairs with the key, without sums beside them."""
    _, gold = build.build(spark, *shop, "small_curated", "small_gold")
    assert all(file.endswith(".zstd.parquet") for file in gold["fact_sales"].inputFiles())
    for view, key in (("vw_product_performance", "product_key"), ("vw_daily_sales", "date_key")):
        plan = spark.table(f"small_gold.{view}")._jdf.queryExecution().executedPlan().toString()
        pairs = re.findall(rf"HashAggregate\(keys=\[{key}#\d+L?, order_id#\d+L?\], functions=\[(.*?)\]", plan)
        assert pairs and not any(pairs)


def test_accepted_and_rejected_rows_and_their_counts(spark, shop):
    build.build(spark, *shop, "split_curated", "split_gold")
    survivors = {"customers": curation.surviving_customers(shop[0]), "products": curation.surviving_products(shop[1]), "orders": curation.surviving_orders(shop[2])}
    counts = spark.table("split_curated.build_counts")
    told = {(row["layer"], row["table_name"]): row["row_count"] for row in counts.collect()}
    for name, rows in survivors.items():
        accepted, rejected = (spark.table(f"split_curated.{kind}_{name}") for kind in build.VERDICTS)
        assert accepted.count() + rejected.count() == rows.count()
        assert accepted.filter("size(reasons) > 0").isEmpty() and rejected.filter("size(reasons) = 0").isEmpty()
        assert told["entities", f"accepted_{name}"] == accepted.count() and told["raw", name] == shop[list(survivors).index(name)].count()
    funnel = {row["entity"]: (row["raw_rows"], row["clean_rows"]) for row in build.build_funnel(counts).collect()}
    clean = {"customers": curation.clean_customers(shop[0]), "products": curation.clean_products(shop[1]), "orders": curation.clean_orders(shop[2])}
    plain = curation.funnel({name: (raw, clean[name]) for name, raw in zip(survivors, shop)})
    assert funnel == {row["entity"]: (row["raw_rows"], row["clean_rows"]) for row in plain.collect()}
    for layer, namespace in (("curated", "split_curated"), ("gold", "split_gold")):
        for (kind, name), rows in told.items():
            if kind == layer:
                assert spark.table(f"{namespace}.{name}").count() == rows


def test_nothing_rejected_gives_an_empty_table(spark, namespace):
    staging = versions.Staging(spark)
    rows = spark.range(3).withColumn("verdict", F.lit("accepted"))
    good, bad = staging.add_parts(rows, "verdict", {"accepted": f"{namespace}.good", "rejected": f"{namespace}.bad"})
    assert ids(good) == [0, 1, 2] and ids(bad) == []
    staging.publish()
    assert ids(spark.table(f"{namespace}.bad")) == []
