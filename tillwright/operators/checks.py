"""Declarative data-quality checks with one common report."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

Tables = Mapping[str, DataFrame]

# Totals are compared as numbers of this type.
COMPARED = "decimal(38,6)"


@dataclass(frozen=True)
class BadRows:
    """Rows for which ``condition`` holds are failures."""

    name: str
    table: str
    condition: Column


@dataclass(frozen=True)
class UniqueKey:
    """Key values found on more than one row are failures."""

    name: str
    table: str
    key: str


@dataclass(frozen=True)
class KnownKey:
    """Distinct key values without a row in ``parent`` are failures; NULL is one of them."""

    name: str
    table: str
    key: str
    parent: str


@dataclass(frozen=True)
class SameTotal:
    """The number ``total`` must be equal, to six decimals, on both tables; a difference is one failure."""

    name: str
    table: str
    other: str
    total: Column


Check = BadRows | UniqueKey | KnownKey | SameTotal


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values on more than one row, with their count."""
    return df.groupBy(key).agg(F.count("*").alias("duplicate_count")).filter("duplicate_count > 1")


def row_counts(tables: Tables) -> DataFrame:
    """One row ``(table_name, row_count)`` per table."""
    return _stacked(
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def side_by_side(left: DataFrame, right: DataFrame, total: Column, left_name: str, right_name: str) -> DataFrame:
    """One row with the same aggregate of two tables."""
    sides = _stacked(
        df.agg(total.alias("total")).select(F.lit(side).alias("side"), "total")
        for side, df in ((left_name, left), (right_name, right))
    )
    return sides.agg(
        *[F.max(F.when(F.col("side") == side, F.col("total"))).alias(side) for side in (left_name, right_name)]
    )


def report(tables: Tables, checks: Iterable[Check]) -> DataFrame:
    """``(check_name, table_name, failed_rows, passed)`` for every check, lazily.

    All that :class:`BadRows` and :class:`SameTotal` need of a table is aggregated in one scan of it, and all that
    :class:`UniqueKey` and :class:`KnownKey` need in one more, of its keys (see :func:`key_profile`).
    A check is identified by its name and table.
    """
    needed: dict[str, list[tuple[Check, str, Column]]] = defaultdict(list)
    keyed: list[UniqueKey | KnownKey] = []
    parts = []
    for check in checks:
        match check:
            case BadRows():
                needed[check.table].append((check, "bad", F.count_if(check.condition)))
            case SameTotal():
                needed[check.table].append((check, "here", check.total))
                needed[check.other].append((check, "there", check.total))
            case UniqueKey() | KnownKey():
                keyed.append(check)
            case _:
                raise TypeError(f"not a check: {check!r}")
    if keyed:
        parts.append(_failed_keys(tables, keyed))
    if needed:
        parts.append(_failed_measures(_stacked(_measured(tables[name], listed) for name, listed in needed.items())))
    return _stacked(parts).withColumn("passed", F.col("failed_rows") == 0)


def enforce(outcome: DataFrame) -> None:
    """Raise when a check of the report failed. The report has one row per declared check."""
    failed = [row for row in outcome.collect() if not row["passed"]]
    if failed:
        listed = ", ".join(f"{row['check_name']} on {row['table_name']} ({row['failed_rows']})" for row in failed)
        raise ValueError(f"data-quality checks failed: {listed}")


def _measured(df: DataFrame, listed: list[tuple[Check, str, Column]]) -> DataFrame:
    """One scan of a table; one row per measure."""
    measures = [measure.cast(COMPARED).alias(f"m{place}") for place, (_, _, measure) in enumerate(listed)]
    rows = [
        F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.table).alias("table_name"),
            F.lit(side).alias("side"),
            F.col(f"m{place}").alias("measured"),
        )
        for place, (check, side, _) in enumerate(listed)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def _failed_measures(measured: DataFrame) -> DataFrame:
    bad, here, there = (F.max(F.when(F.col("side") == side, F.col("measured"))) for side in ("bad", "here", "there"))
    differs = (~here.eqNullSafe(there)).cast("bigint")
    return measured.groupBy("check_name", "table_name").agg(F.coalesce(bad.cast("bigint"), differs).alias("failed_rows"))


def key_profile(tables: Tables, keys: Iterable[tuple[str, str]]) -> DataFrame:
    """``domain, key`` (as text) with one column per table: on how many of its rows the key stands.

    ``keys`` are pairs of table and column; columns of one name are one domain. Every table is read once, whatever the number of
    its keys, and tasks count theirs before the shuffle, so a hot key is one row per task.
    """
    columns: dict[str, list[str]] = defaultdict(list)
    domains: dict[str, list[str]] = defaultdict(list)
    for table, column in keys:
        if column not in columns[table]:
            columns[table].append(column)
            domains[column].append(table)
    numbers = {name: number for number, name in enumerate(domains)}
    # a key is grouped with a number for its domain and one count for each table of that domain, not of all: such rows fill the tasks
    rows = _stacked(
        tables[table].select(
            F.inline(F.array(*(
                F.struct(
                    F.lit(numbers[name]).alias("_domain"), F.col(name).cast("string").alias("key"), F.lit(domains[name].index(table)).alias("_side")
                )
                for name in names
            ))),
        )
        for table, names in columns.items()
    )
    sides = range(max(map(len, domains.values())))
    counts = rows.groupBy("_domain", "key").agg(*(F.count_if(F.col("_side") == side).alias(f"_count{side}") for side in sides))

    def count_of(table: str) -> Column:
        found = F.lit(0).cast("bigint")
        for name in columns[table]:
            found = F.when(F.col("_domain") == numbers[name], F.col(f"_count{domains[name].index(table)}")).otherwise(found)
        return found.alias(table)

    domain = F.element_at(F.array(*map(F.lit, domains)), F.col("_domain") + 1).alias("domain")
    return counts.select(domain, "key", *map(count_of, columns))


def _failed_keys(tables: Tables, checks: list[UniqueKey | KnownKey]) -> DataFrame:
    """``check_name, table_name, failed_rows`` of all key checks, from one profile."""
    used = [(check.table, check.key) for check in checks]
    used += [(check.parent, check.key) for check in checks if isinstance(check, KnownKey)]

    def failed(check: UniqueKey | KnownKey) -> Column:
        here = F.col(f"`{check.table}`")
        match check:
            case UniqueKey():
                wrong = here > 1
            case KnownKey():
                wrong = (here > 0) & (F.col("key").isNull() | (F.col(f"`{check.parent}`") == 0))
        return F.count_if((F.col("domain") == check.key) & wrong)

    counts = key_profile(tables, used).agg(*(failed(check).alias(f"n{place}") for place, check in enumerate(checks)))
    rows = [
        F.struct(F.lit(check.name).alias("check_name"), F.lit(check.table).alias("table_name"), F.col(f"n{place}").alias("failed_rows"))
        for place, check in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _stacked(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
