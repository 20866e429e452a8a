"""Embedding near-dedup with a forest of random-projection trees.

Equal vectors of one label are taken as one. Every tree cuts the vectors of a label by a random direction at the median,
again and again, until a leaf has at most ``LEAF`` vectors; vectors close to a cut go to both sides. All vectors
take part in the cuts, and a level of all trees is cut in one pass over the projections. Vectors are compared in
their leaves, in blocks, and links are those whose cosine in double precision is ``cosine`` or more; a pair that meets
in several leaves counts in the first only. A node that is hardly wider than the overlap (a group of near copies) is not
cut further and compared block by block, however many vectors it has.

Null, empty and zero vectors, vectors with a null or a component that is not finite, and rows without label or key
are linked with nothing. Vectors of different lengths are not compared. Rows that share key, label and vector are copies like
others. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.components import components
from tillwright.llm.rows import small_batches
from tillwright.session import stored

TREES, LEVELS, LEAF, SEED = 4, 24, 1000, 17
#: Half the width of a cut's overlap, in deviations of the difference of two vectors just similar enough.
OVERLAP = 1.2
#: Vectors of one side of a comparison.
BLOCK = 1000


def directions(size: int) -> np.ndarray:
    """One random direction for each tree and level; along it two unit vectors differ by their distance, on average."""
    return np.random.default_rng(SEED).normal(size=(TREES * LEVELS, size))


def _unit(vectors: list) -> np.ndarray:
    found = np.array([np.asarray(vector, np.float64) for vector in vectors])
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def _classes(rows: DataFrame) -> DataFrame:
    """``node, first_id, n, label, vector, projections``: one row per distinct vector of a label."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(directions_of(len(v)) @ (np.asarray(v, np.float64) / np.linalg.norm(np.asarray(v, np.float64)))) for v in frame["vector"]]
            yield frame.assign(projections=found)

    known: dict[int, np.ndarray] = {}

    def directions_of(size: int) -> np.ndarray:
        if size not in known:
            known[size] = directions(size)
        return known[size]

    distinct = rows.groupBy("label", "vector").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    numbered = distinct.select(F.monotonically_increasing_id().alias("node"), "first_id", "n", "label", "vector")
    kinds = {name: numbered.schema[name].dataType.simpleString() for name in ("first_id", "label")}
    return numbered.mapInPandas(
        run, f"node bigint, first_id {kinds['first_id']}, n bigint, label {kinds['label']}, vector array<double>, projections array<double>"
    )


def _leaves(classes: DataFrame, cosine: float) -> DataFrame:
    """``node, tree, leaf`` for every leaf that a vector is in; a leaf is unique among all labels and trees."""
    rows = classes.select(
        "node", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), F.xxhash64("label", F.size("vector")).alias("root"), "projections"
    )
    rows = rows.select("node", "tree", F.xxhash64("root", "tree").alias("leaf"), F.slice("projections", F.col("tree") * LEVELS + 1, LEVELS).alias("along"))
    open_rows, leaves = stored(rows, "tree-rows"), []
    overlap = OVERLAP * max(0.0, 2 - 2 * cosine) ** 0.5
    for level in range(LEVELS):
        here = F.col("along")[level]
        cuts = open_rows.groupBy("leaf").agg(F.count("*").alias("n"), F.percentile_approx(here, [0.25, 0.5, 0.75], 1000).alias("cut"))
        wide = F.col("cut")[2] - F.col("cut")[0] > 2 * overlap  # else half of all would go to both sides
        cuts = stored(cuts.where((F.col("n") > LEAF) & wide).select("leaf", F.col("cut")[1].alias("cut")), "cuts")
        known = open_rows.join(cuts, "leaf", "left")
        leaves.append(known.where("cut IS NULL").select("node", "tree", "leaf"))
        if cuts.isEmpty():
            break
        sides = F.concat(
            F.when(here <= F.col("cut") + overlap, F.array(F.lit(0))).otherwise(F.array().cast("array<int>")),
            F.when(here > F.col("cut") - overlap, F.array(F.lit(1))).otherwise(F.array().cast("array<int>")),
        )
        split = known.where("cut IS NOT NULL").withColumn("side", F.explode(sides))
        open_rows = stored(split.select("node", "tree", F.xxhash64("leaf", "side").alias("leaf"), "along"), "tree-rows")
    else:
        leaves.append(open_rows.select("node", "tree", "leaf"))
    found = leaves[0]
    for part in leaves[1:]:
        found = found.union(part)
    return stored(found, "leaves")


def _compared(classes: DataFrame, leaves: DataFrame, cosine: float) -> DataFrame:
    """Links by blocks of leaves: ``node, links`` (weighted by copies) and ``other``, a node it is connected with or null."""
    every = leaves.groupBy("node").agg(F.collect_list(F.struct("tree", "leaf")).alias("leaves"))
    sizes = stored(leaves.groupBy("leaf").agg(F.count("*").alias("size")).where("size > 1"), "leaf-sizes")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = leaves.join(sizes, "leaf").select("node", "tree", "leaf", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"))
    # a block meets itself and every other one once: the lower number comes first
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("node", "tree", "leaf", "block", other).select(
        "node", "tree", "leaf", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    rows = pairs.join(stored(classes.select("node", "n", "vector").join(every, "node"), "leaf-vectors"), "node")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        tree, leaf, low, high = (int(frame[name].iloc[0]) for name in ("tree", "leaf", "low", "high"))
        left = frame[frame["block"] == low]
        right = left if low == high else frame[frame["block"] == high]
        if not len(left) or not len(right):
            return pd.DataFrame({"node": [], "links": [], "other": []})
        near = _unit(list(left["vector"])) @ _unit(list(right["vector"])).T >= cosine
        if low == high:
            np.fill_diagonal(near, False)
        if near.any():  # a pair counts in the first leaf that both are in
            near &= ~_met_before(left["leaves"], right["leaves"], tree, leaf)
        first, second = left["node"].to_numpy(), right["node"].to_numpy()
        links = pd.DataFrame({"node": first, "links": near @ right["n"].to_numpy(), "other": _joined(near, second, first)})
        if low != high:
            links = pd.concat([links, pd.DataFrame({"node": second, "links": near.T @ left["n"].to_numpy(), "other": _joined(near.T, first, second)})])
        return links[links["links"] > 0]

    return rows.groupBy("leaf", "low", "high").applyInPandas(run, "node bigint, links bigint, other bigint")


def _met_before(left: pd.Series, right: pd.Series, tree: int, leaf: int) -> np.ndarray:
    """Whether two vectors have an earlier leaf in common, by tree and number."""
    numbers: dict[tuple[int, int], int] = {}
    sides = []
    for side in (left, right):
        keys = [[(one["tree"], one["leaf"]) for one in every] for every in side]
        sides.append([[numbers.setdefault(key, len(numbers)) for key in every if key < (tree, leaf)] for every in keys])
    marks = [np.zeros((len(side), max(1, len(numbers))), np.float32) for side in sides]
    for mark, side in zip(marks, sides, strict=True):
        for row, found in enumerate(side):
            mark[row, found] = 1
    return marks[0] @ marks[1].T > 0


def _joined(near: np.ndarray, others: np.ndarray, own: np.ndarray) -> list:
    """For each row a node of its group of links, so that these edges connect what the links connect.

    Rows take the smallest number among themselves and their links until nothing changes.
    """
    columns = np.where(near.any(axis=0), others, np.iinfo(np.int64).max)
    rows = own.copy()
    while True:
        new_columns = np.minimum(columns, np.where(near, rows[:, None], np.iinfo(np.int64).max).min(axis=0, initial=np.iinfo(np.int64).max))
        new_rows = np.minimum(rows, np.where(near, new_columns[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max))
        if (new_rows == rows).all() and (new_columns == columns).all():
            return rows
        rows, columns = new_rows, new_columns


def linked_vectors(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98
) -> DataFrame:
    """``id_col, n_links, component_id, kept`` of every row.

    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest key reachable by links, ``kept`` marks
    the row that bears it. A row without key has no component and is not kept.
    """
    rows = embeddings.select(
        embeddings[f"`{id_col}`"].alias("id"), embeddings[f"`{label_col}`"].alias("label"), embeddings[f"`{vector_col}`"].cast("array<double>").alias("vector")
    )
    plain = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    usable = F.coalesce(plain, F.lit(False)) & F.col("label").isNotNull() & F.col("id").isNotNull()
    # -0.0 and 0.0 are equal
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    classes = stored(_classes(rows.where(usable)), "vector-classes")
    with small_batches(embeddings.sparkSession):
        found = stored(_compared(classes, _leaves(classes, cosine), cosine), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = stored(components(found.select(F.col("node").alias("a"), F.col("other").alias("b"))), "components")
    placed = classes.select("node", "first_id", "n", "label", "vector").join(links, "node", "left").join(joined, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = stored(placed.groupBy("component").agg(F.min("first_id").alias("component_id")), "component-keys")
    named = placed.join(least, "component").select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    return _answered(rows.where(usable), named, id_col).union(
        rows.where(~usable).select(F.col("id").alias(id_col), F.lit(0).cast("bigint"), F.col("id"), F.col("id").isNotNull())
    )


def _answered(rows: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    return rows.join(named, ["label", "vector"]).select(
        F.col("id").alias(id_col), F.col("n_links").cast("bigint").alias("n_links"), "component_id", (F.col("id") == F.col("component_id")).alias("kept")
    )
