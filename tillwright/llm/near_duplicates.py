"""MinHash near-dedup with both extremes of every permutation.

Each permutation of the shingle hashes gives two signature values, its minimum and its maximum, so
half as many hash evaluations fill a signature. Bands of the signature put texts into buckets. In
a bucket a few texts, its hubs, are compared with the others; texts that a round has connected are
not compared again, and the hubs of a bucket become more until all its texts are connected or have
been compared. So a bucket of copies costs as many comparisons as it has texts. Every link is confirmed
on the full sets of both texts.

A pair at the threshold of 0.8 shares no bucket with a probability of (1 - 0.8 ** ROWS) ** BANDS, below one in
six thousand. Two bits of every signature value go with the members of the buckets: a pair is
compared only if as many values agree in them as ``DEVIATIONS`` standard deviations below the expectation at
the threshold, which costs less than one link in thirty thousand and spares texts that are merely alike from 0.70 down.
A bitmap in which every shingle of a text flips one bit goes with them too: the bits in which two bitmaps differ are at
most the shingles that only one of the texts has. Up to some 1,000 shingles pairs are left out by that limit, which loses
none (and reaches almost down to the threshold up to some 300), for longer texts by the same ``DEVIATIONS``.
A pair that shares several buckets is a candidate in the first of them only.

Null and wordless texts have no shingles and are linked with nothing. Rows with a null key have
no component and are not kept. Equal sets form one class before anything is compared, so repeated rows and
copies cost nothing; rows that share a key are rows of their own. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.components import components
from tillwright.llm.rows import keyed, release_unused, small_batches
from tillwright.llm.shingles import chained, mixed, shingle_set
from tillwright.session import stored

ROWS, BANDS = 8, 48
#: How far below its expectation the number of values that agree may be, in standard deviations of it.
DEVIATIONS = 4
#: How many times as many hubs a bucket gets in the next round.
MORE_HUBS = 64
#: Texts that share a bucket for each task that confirms links, at least.
TEXTS = 100
#: Shingles that are permuted together, so that the numbers stay in the processor's cache.
FLAT = 131_072
#: Numbers that hold the bits of one text, two for each value.
WORDS_OF_BITS = -(-ROWS * BANDS // 32)
#: Numbers that hold the bitmap of one text.
WORDS_OF_MAP = 16
_RANDOM = np.random.default_rng(20_260_101)
_FACTORS = _RANDOM.integers(1, 1 << 63, (ROWS * BANDS + 1) // 2, np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, len(_FACTORS), np.uint64)


def min_max_signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row per set (none empty): minimum and maximum under each permutation."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    found = np.empty((2 * len(_FACTORS), len(sets)), np.uint64)
    for n, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
        permuted = flat * factor + shift
        found[2 * n] = np.minimum.reduceat(permuted, starts)
        found[2 * n + 1] = np.maximum.reduceat(permuted, starts)
    return found.T


def _signature_bits(values: np.ndarray) -> np.ndarray:
    """Two well-mixed bits of every value, those of 32 values to a number."""
    scrambled = mixed(values)
    pairs = np.stack([scrambled & np.uint64(1), (scrambled >> np.uint64(1)) & np.uint64(1)], axis=2).astype(np.uint8)
    bits = np.packbits(pairs.reshape(len(values), 2 * values.shape[1]), axis=1)
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8)))).view(np.int64)


def _most_unlike(percent: int) -> int:
    """Values in which two texts at the threshold differ at most, but for a chance that ``DEVIATIONS`` names."""
    expected, size = (1 - percent / 100) * 3 / 4, ROWS * BANDS  # a quarter of unequal values has equal bits
    return int(size * expected + DEVIATIONS * (size * expected * (1 - expected)) ** 0.5) + 1


def _bitmap(found: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the shingles falls on; two bitmaps differ in no more bits than their sets in shingles."""
    size = 64 * WORDS_OF_MAP
    counts = np.bincount((mixed(found) % np.uint64(size)).astype(np.int64), minlength=size)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _most_flipped(percent: int, one: str, other: str) -> str:
    """SQL: in how many bits the bitmaps of two linked texts differ at most, from the sizes of their sets.

    Linked sets differ in no more than a share of their summed sizes. That many shingles are the limit, or if it is lower, ``DEVIATIONS``
    standard deviations over the expected number of bits they leave odd (the deviation of independent bits, which is an upper bound).
    """
    size = 64 * WORDS_OF_MAP
    differing = f"floor({100 - percent} * ({one} + {other}) / {100 + percent}D)"
    odd = f"{size / 2}D * (1 - exp(-{2 / size}D * {differing}))"
    deviation = f"sqrt({size / 4}D * (1 - exp(-{4 / size}D * {differing})))"
    return f"least({differing}, {odd} + {DEVIATIONS} * {deviation} + 1)"


def _band_hashes(values: np.ndarray) -> np.ndarray:
    values = values.reshape(-1, BANDS, ROWS)
    hashes = chained(np.moveaxis(values, 2, 0))
    # 32 bits and the band's number: unlike texts that meet by chance differ in their signatures
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sketches(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per row: key, number of shingles, digest of the set, its band hashes, signature bits and bitmap."""

    def sketched(ids: list, sets: list[np.ndarray]) -> pd.DataFrame:
        full = [found for found in sets if len(found)]
        values = min_max_signatures(full)[:, : ROWS * BANDS] if full else np.zeros((0, ROWS * BANDS), np.uint64)
        bands, bits = iter(_band_hashes(values)), iter(_signature_bits(values))
        return pd.DataFrame({
            "id": ids,
            "n": list(map(len, sets)),
            "digest": [hashlib.md5(found.tobytes()).digest() if len(found) else None for found in sets],
            "bands": [next(bands) if len(found) else None for found in sets],
            "bits": [np.concatenate([next(bits), _bitmap(found)]) if len(found) else None for found in sets],
        })

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_unused()
        for frame in frames:
            ids, sets, size = [], [], 0
            for key, text in zip(frame["id"], frame["text"], strict=True):
                ids.append(key)
                sets.append(shingle_set(text, words))
                size += len(sets[-1])
                if size >= FLAT or len(ids) >= 1000:
                    yield sketched(ids, sets)
                    ids, sets, size = [], [], 0
            if ids:
                yield sketched(ids, sets)

    return keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, n bigint, digest binary, bands array<int>, bits array<bigint>")


def _confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int, tasks: int) -> DataFrame:
    """The pairs ``a, b`` of nodes whose sets are similar enough, by the full sets of both, in ``tasks`` tasks at most."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_unused()
        known: tuple[int | None, np.ndarray | None] = (None, None)
        for frame in frames:
            linked = []
            for row in frame.itertuples(index=False):
                if known[0] != row.b:  # rows of one hub follow each other
                    known = row.b, shingle_set(row.text_b, words)
                one, other = shingle_set(row.text_a, words), known[1]
                common = len(np.intersect1d(one, other, assume_unique=True))
                linked.append(100 * common >= percent * (len(one) + len(other) - common))
            yield frame.loc[linked, ["a", "b"]]

    first = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
    return rows.coalesce(tasks).mapInPandas(run, "a bigint, b bigint")


def _place(node: Column) -> Column:
    """A fixed pseudo-random number from 0 to 1 for each node; the hubs of a bucket are those with the smallest."""
    return F.xxhash64(node) / F.lit(2.0**64) + F.lit(0.5)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept`` for every row.

    ``component_id`` is the smallest key reachable by links, a link being 100 * common shingles >=
    ``percent`` * shingles of either; ``kept`` marks the row that bears that key.
    """
    kind = docs.schema[id_col].dataType
    spark = docs.sparkSession
    key = F.col("id").cast(kind)
    with small_batches(spark):
        sketches = stored(_sketches(docs, id_col, text_col, words), "sketches")
    classes = stored(
        sketches.where("digest IS NOT NULL AND id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min(key).alias("first_id"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits"))
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    bits = [F.col("bits")[n].alias(f"bits_{n}") for n in range(WORDS_OF_BITS + WORDS_OF_MAP)]
    # the signatures follow when it is known which texts share a bucket
    members = classes.select("node", F.posexplode("bands").alias("band", "hash")).select(
        "node", _place(F.col("node")).alias("place"), (F.shiftleft(F.col("band").cast("bigint"), 32) + F.col("hash")).alias("bucket")
    )
    buckets = stored(
        members.groupBy("bucket").agg(F.count("*").alias("size"), F.min("place").alias("least")).where("size > 1"), "buckets"
    )
    shared = stored(members.join(buckets, "bucket").join(classes.select("node", "n", "bands", *bits), "node"), "bucket-members")
    found = _connected(spark, shared, classes, docs, id_col, text_col, words, percent)
    placed = classes.select("digest", "node", "first_id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = stored(placed.join(least, "component").select("digest", "component_id"), "class-components")
    rows = sketches.select(key.alias("id"), F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return rows.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


def _connected(spark, shared, classes, docs, id_col, text_col, words, percent) -> DataFrame:
    """``node, component`` of the texts that are linked with others which share a bucket."""
    if shared.isEmpty():
        return spark.createDataFrame([], "node bigint, component bigint")
    links = spark.createDataFrame([], "a bigint, b bigint")
    nodes = shared.select("node").distinct().join(classes.select("node", "first_id", "digest"), "node")
    with small_batches(spark):
        texts = stored(_class_texts(docs, nodes, id_col, text_col, words), "class-texts")
    tasks = max(1, -(-texts.count() // TEXTS))
    rest = shared.withColumn("component", F.col("node"))
    hubs_wanted = 1
    names = [f"bits_{n}" for n in range(WORDS_OF_BITS + WORDS_OF_MAP)]
    bits, maps = names[:WORDS_OF_BITS], names[WORDS_OF_BITS:]
    # a value differs where either of its two bits does
    unlike = " + ".join(f"bit_count((({name} ^ hub_{name}) | shiftright({name} ^ hub_{name}, 1)) & {0x5555_5555_5555_5555}L)" for name in bits)
    flipped = " + ".join(f"bit_count({name} ^ hub_{name})" for name in maps)
    first_shared = "array_position(zip_with(bands, hub_bands, (one, other) -> one = other), true) = shiftright(bucket + 2147483648L, 32) + 1"
    while True:
        # hubs: at first the member with the smallest place, later all up to a share of the bucket
        until = F.col("least") if hubs_wanted == 1 else F.greatest("least", hubs_wanted / F.col("size"))
        rest = rest.withColumn("until", until)
        hubs = stored(
            rest.where("place <= until").select("bucket", F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("place").alias("hub_place"), F.col("component").alias("hub_component"), F.col("bands").alias("hub_bands"), *(F.col(name).alias(f"hub_{name}") for name in names)),
            "hubs",
        )
        pairs = rest.join(hubs, "bucket").where(
            f"component <> hub_component AND (place > until OR place > hub_place)"
            f" AND 100 * n >= {percent} * hub_n AND 100 * hub_n >= {percent} * n AND {unlike} <= {_most_unlike(percent)}"
            f" AND {flipped} <= {_most_flipped(percent, 'n', 'hub_n')} AND {first_shared}"
        )
        pairs = pairs.select(F.col("node").alias("a"), F.col("hub").alias("b"))
        with small_batches(spark):
            links = links.union(stored(_confirmed(pairs, texts, words, percent, tasks), "links"))
        found = stored(components(links), "components")
        links = found.select(F.col("node").alias("a"), F.col("component").alias("b"))  # stars stand for the links so far
        rest = rest.where("place > until").drop("component").join(found, "node", "left")
        rest = rest.withColumn("component", F.coalesce("component", "node")).drop("until")
        rest = stored(rest, "unconnected")
        open_buckets = stored(
            rest.groupBy("bucket").agg(F.min("component").alias("one"), F.max("component").alias("other")).where("one < other").select("bucket"),
            "open",
        )
        if open_buckets.isEmpty():
            return found
        rest = stored(rest.join(open_buckets, "bucket"), "round")
        hubs_wanted *= MORE_HUBS


def _class_texts(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """One text of each class: the row that bears its first key and has its digest."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_unused()
        for frame in frames:
            same = [
                hashlib.md5(shingle_set(text, words).tobytes()).digest() == bytes(digest)
                for text, digest in zip(frame["text"], frame["digest"], strict=True)
            ]
            yield frame.loc[same, ["node", "text"]]

    keys = keyed(docs, id_col, text=text_col)
    found = keys.join(nodes.withColumn("id", F.col("first_id").cast("string")), "id").select("node", "text", "digest")
    return found.mapInPandas(run, "node bigint, text string").dropDuplicates(["node"])
