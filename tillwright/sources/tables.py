"""Stored tables, views and namespaces of the session's catalogs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tillwright.sources.versions import Staging, found_columns, show


def ensure_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a namespace unless it exists, under ``location`` when one is given."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{place}")


def use_namespace(spark: SparkSession, name: str) -> None:
    """Make ``name`` the namespace of unqualified table names."""
    spark.sql(f"USE {name}")


def save_table(df: DataFrame, name: str, provider: str = "parquet", partition_by: Sequence[str] = ()) -> DataFrame:
    """Create the table or replace all of it, and return it as stored.

    The rows are written beside the old ones, which earlier readers keep, and shown by one switch
    (see :mod:`tillwright.sources.versions`); a catalog of its own replaces the table itself.
    """
    staging = Staging(df.sparkSession, provider)
    staging.add(df, name, partition_by)
    return staging.publish()[name]


def save_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Create or replace a view that is evaluated whenever it is read."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


def mount(spark: SparkSession, alias: str, path: str, provider: str = "parquet") -> DataFrame:
    """Make files written elsewhere readable as table ``alias``, instead of what it showed before.

    Nothing is copied, and dropping a mounted table leaves its files. A table that owns its files is
    not replaced. The files are read before anything is changed, so a bad path leaves the alias as it was.
    """
    if spark.catalog.tableExists(alias) and spark.catalog.getTable(alias).tableType != "EXTERNAL":
        raise ValueError(f"{alias} is a table of its own and cannot be mounted over")
    schema, partition_by = found_columns(spark, alias, path, provider)
    show(spark, alias, path, schema, provider, partition_by)
    return spark.table(alias)


def mount_all(spark: SparkSession, namespace: str, paths: Mapping[str, str], provider: str = "parquet") -> dict[str, DataFrame]:
    """Mount several folders under their aliases and refresh them."""
    mounted = {alias: mount(spark, f"{namespace}.{alias}", path, provider) for alias, path in paths.items()}
    refresh(spark, *(f"{namespace}.{alias}" for alias in mounted))
    return mounted


def alias_table(spark: SparkSession, alias: str, table: str) -> DataFrame:
    """Make a table of one layer readable under another name in the next."""
    return save_view(spark, alias, f"SELECT * FROM {table}")


def refresh(spark: SparkSession, *names: str) -> None:
    """Forget cached file lists of the tables, so that rewritten files are seen."""
    for name in names:
        spark.catalog.refreshTable(name)


def names_in(spark: SparkSession, namespace: str) -> list[str]:
    """Names of the tables and views of a namespace; temporary views belong to none."""
    return sorted(entry.name for entry in spark.catalog.listTables(namespace) if not entry.isTemporary)
