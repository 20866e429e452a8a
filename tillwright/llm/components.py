"""Connected components of a graph that is as large as the data."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.session import stored

#: Edges for each task once tasks have contracted theirs; nodes whose links one task holds at once.
EDGES, NODES = 100_000, 500_000


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges that connect the same nodes: each task links every node of its own edges to the smallest one it reaches by them."""

    def stars(parents: dict[int, int]) -> pd.DataFrame:
        roots = [_root(parents, node) for node in parents]
        return pd.DataFrame({"u": list(parents), "v": roots}, dtype="int64")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parents: dict[int, int] = {}
        for frame in frames:
            for u, v in zip(frame["u"].tolist(), frame["v"].tolist(), strict=True):
                one, other = _root(parents, u), _root(parents, v)
                if one != other:
                    parents[max(one, other)] = min(one, other)
            if len(parents) >= NODES:
                yield stars(parents)
                parents = {}
        yield stars(parents)

    return edges.mapInPandas(run, "u bigint, v bigint")


def _root(parents: dict[int, int], node: int) -> int:
    """The smallest node that ``node`` is linked to; nodes on the way are linked further up."""
    while (above := parents.get(node)) is not None:
        higher = parents.get(above)
        if higher is not None:
            parents[node] = higher
        node = above
    return node


def _with_smallest(edges: DataFrame, down: DataFrame) -> DataFrame:
    """The edges ``down`` with ``m``, the smallest neighbour that ``edges`` has for their ``u``.

    Tasks reduce their edges first, so a hub sends one row per task. The join is on another form of ``u``,
    so both sides are shuffled for it and adaptive execution can split a hub's edges.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.bitwise_not("u").alias("k"), "m")
    return down.withColumn("k", F.bitwise_not("u")).join(least, "k").drop("k")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour is linked to the smallest one, the node itself included."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_smallest(both, both.where("v > u"))
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node itself, is linked to the smallest one."""
    linked = _with_smallest(edges, edges)
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every ``u`` has one ``v``, which has none itself."""
    twice = edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
    onward = edges.select(F.col("v").alias("u")).join(edges, "u", "left_semi")
    return twice.isEmpty() and onward.isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``: the smallest node that can be reached.

    Tasks contract their edges, first as they come, then ``EDGES`` to a task; what one task has contracted alone is stars. Several
    alternate stars (large, then small) until every component is one star; each round is written to the
    shared folder, which cuts the lineage. Links to oneself, nulls and repeats don't matter.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    first = stored(_contracted(links), "edges")
    tasks = max(1, -(-first.count() // EDGES))
    now = stored(_contracted(first.coalesce(tasks)), "contracted")
    while tasks > 1 and not _are_stars(now):
        now = stored(_small_star(stored(_large_star(now).coalesce(tasks), "large-star")).coalesce(tasks), "stars")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.coalesce(tasks))
