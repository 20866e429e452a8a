"""What Spark makes of the plans: pruned scans, no one-task stages over data, skew handled."""

import contextlib
import io
import os
import re

import pytest
from pyspark.sql import functions as F

from querybook.spark_queries import QUERIES
from tillwright import session
from tillwright.operators.checks import BadRows, KnownKey, SameTotal, UniqueKey, report
from tillwright.operators.dedup import one_row_per_key
from tillwright.operators.keys import dense_key
from tillwright.plans import curation, reports, sales, star
from tillwright.session import read_alike, shared_dir, stored

SF_DIR = "/root/testdata/sf0.001"


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def made(df):
    """What ran, after an action; an exchange that was read again is named there, without the plan below it."""
    return plan(df, "simple").split("Initial Plan")[0].replace("ReusedExchange", "").replace(", Exchange", "")


@pytest.fixture(scope="module")
def sold(spark):
    """Sales with one customer and one product holding a third of the rows."""
    hot = "case when id % 3 = 0 then 7 else id % 5000 end"
    orders = spark.range(0, 60000, 1, 8).selectExpr(
        "cast(id as int) order_id", f"cast({hot} as int) customer_id", f"format_string('P%04d', {hot}) product_id",
        "date_add(date'2023-01-01', cast(id % 400 as int)) order_date", "date'2024-06-01' ship_date",
        "cast(1 + id % 9 as int) quantity", "cast(5 + id % 50 as decimal(10,2)) unit_price", "cast(id % 20 as decimal(5,2)) discount_pct",
        "element_at(array('Card','Cash','Wire'), cast(1 + id % 3 as int)) payment_method", "'Delivered' order_status",
        "cast(10 + id % 90 as decimal(27,2)) total_amount",
    )
    customers = spark.range(5000).selectExpr(
        "cast(id as int) customer_id", "concat('f', id) first_name", "'l' last_name", "'USA' country", "'NY' state"
    )
    products = spark.range(5000).selectExpr(
        "format_string('P%04d', id) product_id", "concat('n', id) product_name", "concat('c', id % 7) category",
        "'b' brand", "cast(3 as decimal(10,2)) cost",
    )
    return {name: stored(df, f"plans-{name}") for name, df in (("orders", orders), ("customers", customers), ("products", products))}


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|MapInPandas|BatchEval|CartesianProduct", text)


def test_category_report_reads_only_its_columns(sold):
    fact = sales.enriched_sales(sold["orders"], sold["customers"], sold["products"])
    text = plan(sales.category_summary(fact))
    schemas = re.findall(r"ReadSchema: struct<(.*)>", text)
    read = {column.split(":")[0] for schema in schemas for column in schema.split(",") if ":" in column}
    assert read == {"customer_id", "product_id", "quantity", "total_amount", "category", "cost"}
    assert "PushedFilters: [IsNotNull(product_id), IsNotNull(customer_id)]" in text


def test_one_fact_shuffle_per_key_report(sold, spark):
    """Per-customer report: the join behind the aggregation moves one row per customer."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        customers = sold["customers"].withColumn("customer_key", F.col("customer_id").cast("bigint"))
        fact = sold["orders"].withColumns({"customer_key": F.col("customer_id").cast("bigint"), "profit": F.col("total_amount")})
        text = plan(reports.customer_performance(fact, customers), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    fact_side = [line for line in text.splitlines() if "Exchange hashpartitioning(customer_key" in line and "order_id" in line]
    assert len(fact_side) == 1
    assert text.index("SortMergeJoin") < text.index("HashAggregate") < text.index("FileScan")


def test_dense_key_keeps_rows_out_of_one_task(sold):
    """Only slice counts meet in the single-partition window."""
    text = plan(dense_key(sold["customers"], "customer_id", "customer_key"), "simple")
    single = text[text.index("Exchange SinglePartition"):]
    assert re.match(r"Exchange SinglePartition.*\n.*HashAggregate\(keys=\[\S+\], functions=\[count", single)
    assert text.count("Exchange SinglePartition") == 1


def test_key_checks_share_one_scan_per_table(sold):
    tables = {name: sold[name] for name in ("orders", "customers", "products")}
    checks = [UniqueKey(f"{key} repeats", name, key) for name, key in (("orders", "order_id"), ("customers", "customer_id"), ("products", "product_id"))]
    checks += [KnownKey("customer unknown", "orders", "customer_id", "customers"), KnownKey("product unknown", "orders", "product_id", "products")]
    plan = report(tables, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3 and "Join" not in plan


def test_row_checks_share_one_scan_per_table(sold):
    tables = {"orders": sold["orders"], "again": sold["orders"]}
    checks = [BadRows(f"{name} is null", "orders", F.col(name).isNull()) for name in ("order_id", "customer_id", "product_id")]
    checks += [SameTotal("rows differ", "orders", "again", F.count("*")), SameTotal("units differ", "again", "orders", F.sum("quantity"))]
    outcome = report(tables, checks)
    assert plan(outcome, "simple").count("FileScan") == 2
    assert all(row.passed for row in outcome.collect()) and outcome.count() == 5


def test_readers_alike_share_the_exchanges(spark):
    """Two readers of other columns: the join below them is made once, and its rows are those of the plain frame."""
    lines = spark.createDataFrame([(i % 7 or None, f"p{i % 3}", i) for i in range(50)], "id int, code string, amount int")
    parents = spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "id int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lines.join(parents, "id")
        outcomes = []
        for df, exchanges in ((joined, 3), (read_alike(joined, "id", "code", "amount"), 2)):
            both = df.groupBy("id").agg(F.sum("amount")).union(df.groupBy("id").agg(F.countDistinct("code")))
            outcomes.append((sorted(map(tuple, both.collect())), sorted(map(tuple, df.collect()))))
            assert made(both).count("Exchange hashpartitioning(id") == exchanges
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert outcomes[0] == outcomes[1]


def test_full_report_makes_the_sales_once(spark):
    """Six readers of the sales and two of the fact: lines and headers are sent and joined once, and so is the fact."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        outcome = QUERIES["dq_full_report"](spark, SF_DIR)
        assert len(outcome.collect()) == 21
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    text = made(outcome)
    assert text.count("FileScan parquet [l_orderkey") == text.count("FileScan parquet [o_orderkey") == 1
    sent = re.findall(r"Exchange hashpartitioning\((\w+)#.*\n.*Project \[.*total_amount", text)
    assert sorted(sent) == ["customer_id", "product_id", "product_id"]


def test_dedup_reduces_before_the_shuffle(sold, spark):
    """Every task sends at most one row of a hot key."""
    copies = sold["orders"].withColumn("order_id", F.lit("same"))
    text = plan(one_row_per_key(copies, ["order_id"]), "simple")
    assert text.index("Exchange hashpartitioning") < text.index("partial_max")
    assert one_row_per_key(copies, ["order_id"]).count() == 1


def test_junk_keys_never_reach_the_shuffle(spark):
    raw = QUERIES["src1_orders_csv"](spark, SF_DIR)
    text = plan(curation.surviving_orders(raw), "simple")
    below = text[text.index("Exchange hashpartitioning"):]
    assert re.search(r"Filter.*RLIKE\(trim\(order_id", below)


def test_skewed_join_is_split(sold, spark):
    """Without broadcast the partition of the hot customer is cut into several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        keyed = sold["customers"].withColumn("customer_key", F.col("customer_id").cast("bigint"))
        products = sold["products"].withColumn("product_key", F.lit(1).cast("bigint"))
        fact = star.sales_fact(sales.enriched_sales(sold["orders"], sold["customers"], sold["products"]), keyed, products)
        assert fact.count() == 60000
        rows = fact.select("order_id", "customer_key")
        assert len(rows.collect()) == 60000
        assert "SortMergeJoin(skew=true)" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_reports_do_not_depend_on_partitions(sold, spark, partitions):
    def results():
        fact = sales.enriched_sales(sold["orders"], sold["customers"], sold["products"])
        frames = [sales.category_summary(fact), sales.payment_summary(fact), reports.executive_kpis(fact)]
        return [sorted(map(repr, frame.collect())) for frame in frames]

    expected = results()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert results() == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_local_session_without_setting_gets_a_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_DIR", "spark.tillwright.unset")
    assert os.path.isdir(shared_dir(spark))
    assert shared_dir(spark) == shared_dir(spark)


def test_intermediate_data_goes_to_the_shared_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    assert stored(spark.range(3).toDF("n"), "probe").count() == 3
    assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["probe"]
