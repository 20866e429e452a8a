"""The whole batch: raw frames → curated tables → star schema → reporting views → checks.

Every table is written before anything is derived from it, so the cleaning runs once, later steps
read columns of stored files, and all tables of a run agree with each other. Nothing is shown in the catalog
before all checks have passed; then all tables and views are switched to the new run.

Rows that break a rule are stored with their reasons, in the same pass that stores the others. Raw rows are counted while
they are read and stored rows from their files, so no count reads the raw data again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tillwright.functions.numbers import ID
from tillwright.functions.text import PRODUCT_ID_PATTERN
from tillwright.operators.checks import enforce, report, row_counts
from tillwright.operators.keys import stable_key
from tillwright.plans import curation, reports, sales, star, validation, views
from tillwright.sources.tables import ensure_namespace
from tillwright.sources.versions import Staging

Layer = dict[str, DataFrame]

# Values of the column by which accepted and rejected rows are parted when they are written.
VERDICTS = ("accepted", "rejected")


def split_entity(staging: Staging, survivors: DataFrame, rules: Mapping[str, Column], namespace: str, accepted: str, rejected: str) -> Layer:
    """Store accepted and rejected survivors of an entity in one pass, as two tables; both have ``reasons``."""
    judged = curation.with_reasons(survivors, rules)
    verdict = F.when(F.size("reasons") > 0, VERDICTS[1]).otherwise(VERDICTS[0])
    names = (accepted, rejected)
    parts = dict(zip(VERDICTS, (f"{namespace}.{name}" for name in names)))
    return dict(zip(names, staging.add_parts(judged.withColumn("verdict", verdict), "verdict", parts)))


def stage_entities(
    staging: Staging, customers: DataFrame, products: DataFrame, orders: DataFrame, namespace: str,
    payment_names=None, statuses=None, id_type: str = ID, id_pattern: str = PRODUCT_ID_PATTERN,
) -> Layer:
    """Accepted and rejected rows of the three raw frames, one pass over each."""
    who = curation.surviving_customers(customers)
    what = curation.surviving_products(products)
    bought = curation.surviving_orders(orders, payment_names, id_type)
    return (
        split_entity(staging, who, curation.customer_rules(who), namespace, "accepted_customers", "rejected_customers")
        | split_entity(staging, what, curation.product_rules(), namespace, "accepted_products", "rejected_products")
        | split_entity(staging, bought, curation.order_rules(statuses, id_pattern), namespace, "accepted_orders", "rejected_orders")
    )


def stage_curated(staging: Staging, customers: DataFrame, products: DataFrame, orders: DataFrame, namespace: str) -> Layer:
    """The seven curated tables from clean entities (or stored increments of them).

    The orders are joined once: the table of referenced orders and all marts are read back out of
    the stored sales.
    """
    layer: Layer = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        layer[name] = staging.add(df, f"{namespace}.{name}")
        return layer[name]

    known_customers = keep("customers", customers)
    known_products = keep("products", products)
    sold = keep("sales_curated", sales.enriched_sales(orders, known_customers, known_products))
    keep("orders", sales.orders_of(sold))
    keep("margin", sales.margins(sold))
    keep("category_summary", sales.category_summary(sold))
    keep("payment_summary", sales.payment_summary(sold))
    return layer


def build_curated(
    customers: DataFrame, products: DataFrame, orders: DataFrame, namespace: str, provider: str = "parquet"
) -> Layer:
    """The curated tables, shown as soon as all are written."""
    staging = Staging(customers.sparkSession, provider)
    layer = stage_curated(staging, customers, products, orders, namespace)
    staging.publish()
    return layer


def stage_keys(staging: Staging, members: DataFrame, by: str, key: str, name: str) -> DataFrame:
    """Members with keys that outlive rebuilds; the table ``name`` keeps all that were ever given."""
    spark = staging.spark
    nothing = members.select(by, F.lit(0).cast("bigint").alias(key)).limit(0)
    keyed, every = stable_key(members, by, key, spark.table(name) if spark.catalog.tableExists(name) else nothing)
    staging.add(every, name)
    return keyed


def stage_gold(staging: Staging, curated: Layer, namespace: str, stable_keys: bool = False) -> Layer:
    """Dimensions and fact from the curated tables; with ``stable_keys`` earlier runs' surrogate keys are kept."""
    sold = curated["sales_curated"]
    if stable_keys:
        who = stage_keys(staging, curated["customers"], "customer_id", "customer_key", f"{namespace}.customer_keys")
        what = stage_keys(staging, curated["products"], "product_id", "product_key", f"{namespace}.product_keys")
    else:
        who, what = star.customer_dimension(curated["customers"]), star.product_dimension(curated["products"])
    dimensions = {
        "dim_customer": who,
        "dim_product": what,
        "dim_date": star.date_dimension(sold),
        "dim_payment": star.payment_dimension(sold),
        "dim_order_status": star.status_dimension(sold),
    }
    layer = {name: staging.add(df, f"{namespace}.{name}") for name, df in dimensions.items()}
    fact = star.sales_fact(sold, layer["dim_customer"], layer["dim_product"])
    layer["fact_sales"] = staging.add(fact, f"{namespace}.fact_sales")
    return layer


def build_gold(curated: Layer, namespace: str, provider: str = "parquet") -> Layer:
    """The star schema, shown as soon as all of it is written."""
    staging = Staging(curated["sales_curated"].sparkSession, provider)
    layer = stage_gold(staging, curated, namespace)
    staging.publish()
    return layer


def report_frames(gold: Layer) -> Layer:
    """The six reporting views as lazy frames over the star schema."""
    fact = gold["fact_sales"]
    return {
        "vw_executive_kpis": reports.executive_kpis(fact),
        "vw_daily_sales": reports.daily_sales(fact, gold["dim_date"]),
        "vw_category_performance": reports.category_performance(fact, gold["dim_product"]),
        "vw_product_performance": reports.product_performance(fact, gold["dim_product"]),
        "vw_payment_performance": reports.payment_performance(fact),
        "vw_customer_performance": reports.customer_performance(fact, gold["dim_customer"]),
    }


def publish_reports(gold: Layer) -> Layer:
    """Create or replace the six views of the session; each is evaluated whenever it is read."""
    frames = report_frames(gold)
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def quality_report(curated: Layer, gold: Layer) -> DataFrame:
    """The report of all checks on both layers."""
    return report({**curated, **gold}, validation.curated_checks() + validation.gold_checks())


def layer_counts(spark: SparkSession, read: Mapping[str, int], entities: Layer, curated: Layer, gold: Layer) -> DataFrame:
    """``(layer, table_name, row_count)`` of all that a run read and stored.

    Counting a stored table reads the footers of its files only.
    """
    told = [
        F.struct(F.lit("raw").alias("layer"), F.lit(name).alias("table_name"), F.lit(rows).cast("bigint").alias("row_count"))
        for name, rows in read.items()
    ]
    raw = spark.range(1).select(F.inline(F.array(*told)))
    stored = (("entities", entities), ("curated", curated), ("gold", gold))
    for name, tables in stored:
        if tables:
            raw = raw.union(row_counts(tables).select(F.lit(name), "table_name", "row_count"))
    return raw


def build_funnel(counts: DataFrame) -> DataFrame:
    """``(entity, raw_rows, clean_rows)`` from the counts of a build."""
    entity = F.when(F.col("layer") == "raw", F.col("table_name")).otherwise(F.replace("table_name", F.lit("accepted_")))
    of = counts.filter("layer = 'raw' OR layer = 'entities' AND table_name LIKE 'accepted%'").withColumn("entity", entity)
    rows = [
        F.max(F.when((F.col("layer") == "raw") == raw, F.col("row_count"))).alias(name)
        for name, raw in (("raw_rows", True), ("clean_rows", False))
    ]
    return of.groupBy("entity").agg(*rows)


def build(
    spark: SparkSession,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    curated: str = "curated",
    gold: str = "gold",
    provider: str = "parquet",
    stable_keys: bool = False,
    **order_options,
) -> tuple[Layer, Layer]:
    """Run everything on raw frames and show the result; raises when a check fails, and then nothing has changed.

    ``order_options`` are those of :func:`curation.clean_orders`. Surrogate keys are 1..n in id order, or with ``stable_keys`` those
    of earlier runs and further ones behind them. Besides the returned layers, ``curated`` gets accepted and rejected
    rows of the three entities and ``build_counts``, and ``gold`` the six views. The counts of raw rows are those of one
    pass; a stage that had to be run again after losing an executor may count its rows twice there.
    """
    for namespace in (curated, gold):
        ensure_namespace(spark, namespace)
    staging = Staging(spark, provider)
    seen = {name: Observation(name) for name in ("customers", "products", "orders")}
    watched = [
        df.observe(seen[name], F.count(F.lit(1)).alias("rows")) for name, df in zip(seen, (customers, products, orders))
    ]
    entities = stage_entities(staging, *watched, curated, **order_options)
    curated_layer = stage_curated(
        staging, entities["accepted_customers"].drop("reasons"), entities["accepted_products"].drop("reasons"),
        curation.with_total(entities["accepted_orders"].drop("reasons")), curated,
    )
    gold_layer = stage_gold(staging, curated_layer, gold, stable_keys)
    enforce(quality_report(curated_layer, gold_layer))
    read = {name: one.get["rows"] for name, one in seen.items()}
    staging.add(layer_counts(spark, read, entities, curated_layer, gold_layer), f"{curated}.build_counts")
    views.stage_views(staging, gold)
    shown = staging.publish()
    shown_gold = {name: shown[f"{gold}.{name}"] for name in gold_layer}
    publish_reports(shown_gold)
    return {name: shown[f"{curated}.{name}"] for name in curated_layer}, shown_gold
