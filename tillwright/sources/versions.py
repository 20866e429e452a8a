"""Tables that are replaced by showing other files, never by rewriting those that someone reads.

Every version of a table has a folder of its own below its namespace. A version is written first, can be read and checked
by its path, and becomes the table by one change of the table's location. Readers that began earlier, and other sessions that have read the table
and not refreshed it, keep the old files until :func:`remove_old_versions` takes them. :class:`Staging` does this for all tables and views of a run: nothing is visible
before :meth:`Staging.publish`, and what a failing publication has switched already is switched back.

A catalog of its own (``catalog.namespace.table``) keeps versions itself; there the staged rows are handed over at the end.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillwright.session import make_folder, remove_folder, scratch_path, subfolders

SESSION_CATALOG = "spark_catalog"
FOLDER = "table-versions"
INCOMING = "__incoming"
#: Stored tables are written once and read often: a quarter to a third less to write than with the default codec.
COMPRESSION = {"parquet": {"compression": "zstd"}}


def own_catalog(name: str) -> bool:
    """Whether a table name leads to another catalog than that of the session."""
    parts = name.split(".")
    return len(parts) > 2 and parts[0] != SESSION_CATALOG


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    namespace, _, table = name.removeprefix(f"{SESSION_CATALOG}.").rpartition(".")
    return namespace or spark.catalog.currentDatabase(), table


def versions_folder(spark: SparkSession, name: str) -> str:
    """The folder of all versions of a table of the session's catalog."""
    namespace, table = _split(spark, name)
    return f"{spark.catalog.getDatabase(namespace).locationUri.rstrip('/')}/{FOLDER}/{table}"


def new_path(spark: SparkSession, name: str) -> str:
    """Where the next version goes; later ones sort behind earlier ones."""
    if own_catalog(name):
        return scratch_path(spark, "staged")
    return f"{versions_folder(spark, name)}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says about a table or view beside its columns."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    names = [row["col_name"] for row in rows]
    begin = names.index("# Detailed Table Information") if "# Detailed Table Information" in names else 0
    return {row["col_name"]: row["data_type"] for row in rows[begin:]}


def location_of(spark: SparkSession, name: str) -> str | None:
    """The folder that a table shows now; None without such a table."""
    return _described(spark, name).get("Location") if spark.catalog.tableExists(name) else None


def view_text(spark: SparkSession, name: str) -> str | None:
    """The query of a view; None without such a view."""
    return _described(spark, name).get("View Text") if spark.catalog.tableExists(name) else None


def _quoted(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def _found_by_path(spark: SparkSession) -> Iterator[None]:
    """Tables made inside find their partitions by path. A list of them in the catalog would go on showing the old version's."""
    name = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _create(spark: SparkSession, name: str, path: str, schema: StructType, provider: str, partition_by: Sequence[str]) -> None:
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    with _found_by_path(spark):
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {provider}{parts} LOCATION {_quoted(path)}")


def found_columns(spark: SparkSession, name: str, path: str, provider: str) -> tuple[StructType, list[str]]:
    """Schema and partition columns of files, as the catalog finds them."""
    spark.sql(f"DROP TABLE IF EXISTS {name}{INCOMING}")
    spark.sql(f"CREATE TABLE {name}{INCOMING} USING {provider} LOCATION {_quoted(path)}")
    schema = spark.table(f"{name}{INCOMING}").schema
    parts = [column.name for column in spark.catalog.listColumns(f"{name}{INCOMING}") if column.isPartition]
    spark.sql(f"DROP TABLE {name}{INCOMING}")
    return schema, parts


def show(spark: SparkSession, name: str, path: str, schema: StructType, provider: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Let table ``name`` show the files at ``path``.

    Where the columns stay the same this is one change of the location. Otherwise the new table is made under another
    name, which proves it can be made, and takes the old one's place by drop and rename. A table that
    owns its files loses them by that; all tables written here don't.
    """
    if not spark.catalog.tableExists(name):
        _create(spark, name, path, schema, provider, partition_by)
        return
    told = _described(spark, name)
    if told.get("Type") == "VIEW":
        raise ValueError(f"{name} is a view")
    before = [(field.name, field.dataType.simpleString()) for field in spark.table(name).schema]
    now = [(field.name, field.dataType.simpleString()) for field in schema]
    parts = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    if told.get("Type") == "EXTERNAL" and told.get("Provider", "").lower() == provider.lower() and before == now and parts == list(partition_by):
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}{INCOMING}")
        _create(spark, f"{name}{INCOMING}", path, schema, provider, partition_by)
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {name}{INCOMING} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """Folders of all stored versions of a table, the oldest first."""
    return sorted(subfolders(spark, versions_folder(spark, name)))


def remove_old_versions(spark: SparkSession, name: str, keep: int = 1) -> list[str]:
    """Delete all but the shown version and the ``keep`` newest others, which readers may still be at; returns what went."""
    now = location_of(spark, name)
    current = [path for path in versions(spark, name) if now and f"{now}/".startswith(f"{path}/")]
    others = [path for path in versions(spark, name) if path not in current]
    gone = others[: max(len(others) - keep, 0)]
    for path in gone:
        remove_folder(spark, path)
    return gone


@dataclass(frozen=True)
class _Table:
    path: str
    schema: StructType
    provider: str
    partition_by: tuple[str, ...]


class Staging:
    """The tables and views of one run, written but not yet shown."""

    def __init__(self, spark: SparkSession, provider: str = "parquet"):
        self.spark, self.provider = spark, provider
        self.tables: dict[str, _Table] = {}
        self.views: dict[str, str] = {}

    def _read(self, table: _Table, columns: Sequence[str]) -> DataFrame:
        return self.spark.read.format(table.provider).schema(table.schema).load(table.path).select(*(f"`{name}`" for name in columns))

    def add(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the next version of a table and return it as stored."""
        provider = "parquet" if own_catalog(name) else self.provider
        path = new_path(self.spark, name)
        df.write.format(provider).options(**COMPRESSION.get(provider, {})).partitionBy(*partition_by).save(path)
        last = [df.schema[column] for column in partition_by]
        schema = StructType([field for field in df.schema if field.name not in partition_by] + last)
        self.tables[name] = _Table(path, schema, provider, tuple(partition_by))
        return self._read(self.tables[name], df.columns)

    def add_parts(self, df: DataFrame, column: str, names: dict[str, str]) -> list[DataFrame]:
        """Write several tables in one pass: the rows with each value of a text column go to the table ``names`` has for it.

        The column itself is not stored. A value without rows gives an empty table.
        """
        first = next(iter(names.values()))
        provider = "parquet" if own_catalog(first) else self.provider
        path = new_path(self.spark, first)
        df.write.format(provider).options(**COMPRESSION.get(provider, {})).partitionBy(column).save(path)
        schema = StructType([field for field in df.schema if field.name != column])
        frames = []
        for value, name in names.items():
            part = f"{path}/{column}={value}"
            make_folder(self.spark, part)
            self.tables[name] = _Table(part, schema, provider, ())
            frames.append(self._read(self.tables[name], schema.names))
        return frames

    def add_view(self, name: str, query: str) -> None:
        """Remember a view; its query names tables as they will be after the publication."""
        self.views[name] = query

    def _show(self, name: str, table: _Table) -> None:
        if own_catalog(name):
            self._read(table, table.schema.names).writeTo(name).using(self.provider).createOrReplace()
        else:
            show(self.spark, name, table.path, table.schema, table.provider, table.partition_by)

    def publish(self) -> dict[str, DataFrame]:
        """Show all tables, then create the views in the order given; all of it or, when a step fails, nothing."""
        undo = []
        try:
            for name, table in self.tables.items():
                before = None if own_catalog(name) else self._state(name)
                undo.append((name, table, before))
                self._show(name, table)
            for name, query in self.views.items():
                undo.append((name, None, view_text(self.spark, name)))
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
        except Exception:
            for name, table, before in reversed(undo):
                self._restore(name, table, before)
            raise
        return {name: self.spark.table(name) for name in [*self.tables, *self.views]}

    def _state(self, name: str) -> _Table | None:
        if not self.spark.catalog.tableExists(name):
            return None
        told, parts = _described(self.spark, name), [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
        return _Table(told.get("Location", ""), self.spark.table(name).schema, told.get("Provider", self.provider), tuple(parts))

    def _restore(self, name: str, table: _Table | None, before: _Table | str | None) -> None:
        """Undo one step of a failed publication. Another catalog's table has its own history to go back to."""
        if table is not None and own_catalog(name):
            return
        kind = "VIEW" if table is None else "TABLE"
        if before is None:
            self.spark.sql(f"DROP {kind} IF EXISTS {name}")
        elif isinstance(before, str):
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {before}")
        elif _described(self.spark, name).get("Type") != "VIEW" and location_of(self.spark, name) != before.path:
            show(self.spark, name, before.path, before.schema, before.provider, before.partition_by)
