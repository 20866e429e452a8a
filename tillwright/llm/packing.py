"""Best-fit packing of token sequences by a grouping genetic algorithm.

Texts are encoded, ended by an id, and cut into pieces of at most ``capacity`` ids if they are longer; a full piece is a
sequence of its own. The others are dealt in the order of their lengths into shards of about ``SHARD`` pieces, each like the whole. Of every
shard several islands evolve packings of their own: a crossover takes whole well-filled sequences from one
parent, drops the other's sequences that share a piece with them, and puts displaced pieces where they fit best, largest
first. After each epoch every island gets the best packing of its neighbour. When the epochs are over,
sequences of the best packing that are filled to ``FILLED`` stay; the pieces of all others are dealt to fewer shards on the next level. The levels end
with a single shard, or with one that neither fills ``PROGRESS`` of its pieces nor saves as many of its sequences; a level that
needs more sequences than the one before had for the same pieces is given up for that one's.

A shard whose packing has as few sequences as its pieces need at least is not evolved further. Null texts are empty and have the
end id only. Null and repeated keys, repeated rows and other columns are of no effect: each row is packed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.rows import keyed
from tillwright.llm.tokens import library_table, share_definition, texts_of
from tillwright.session import stored

CAPACITY = 2048
#: Pieces of a shard, islands of a shard, packings of an island, epochs, crossovers per epoch, and the filled share that stays.
SHARD, ISLANDS, POPULATION, EPOCHS, CROSSOVERS, FILLED = 20_000, 2, 4, 2, 12, 0.995
#: The share of pieces filled, or of sequences saved, for which another level of several shards is worth its passes.
PROGRESS = 0.02


class Packing:
    """A packing of ``lengths``: the sequence of each piece and the fill of each sequence."""

    def __init__(self, bins: np.ndarray, lengths: np.ndarray, capacity: int):
        _, self.bins = np.unique(bins, return_inverse=True)
        self.fill = np.bincount(self.bins, weights=lengths).astype(np.int64)
        self.lengths, self.capacity = lengths, capacity

    def score(self) -> tuple[int, float]:
        """Fewer sequences are better, then unequal fills: they leave room together."""
        return -len(self.fill), float(((self.fill / self.capacity) ** 2).mean()) if len(self.fill) else 0.0


def best_fit(pieces: np.ndarray, bins: np.ndarray, fill: list[int], lengths: np.ndarray, capacity: int) -> None:
    """Put the pieces, in the order given, each where the least room remains; ``bins`` and ``fill`` are changed."""
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some sequence has room r
    for number, filled in enumerate(fill):
        if 0 <= filled < capacity:
            rooms[capacity - filled].append(number)
            open_rooms |= 1 << (capacity - filled)
    for piece, length in zip(pieces.tolist(), lengths[pieces].tolist(), strict=True):
        enough = open_rooms >> length
        if enough:
            room = length + (enough & -enough).bit_length() - 1
            number = rooms[room].pop()
            if not rooms[room]:
                open_rooms &= ~(1 << room)
        else:
            room, number = capacity, len(fill)
            fill.append(0)
        bins[piece] = number
        fill[number] += length
        if room > length:
            rooms[room - length].append(number)
            open_rooms |= 1 << (room - length)


def first_packing(lengths: np.ndarray, capacity: int, random: np.random.Generator, disorder: float) -> Packing:
    """Best fit of the pieces by falling length, the order disturbed a little."""
    order = np.argsort(-lengths * (1 + disorder * random.random(len(lengths))), kind="stable")
    bins = np.zeros(len(lengths), np.int64)
    best_fit(order, bins, [], lengths, capacity)
    return Packing(bins, lengths, capacity)


def crossover(receiver: Packing, giver: Packing, random: np.random.Generator) -> Packing:
    """Inject well-filled sequences of ``giver`` into ``receiver`` and place anew what they displace."""
    ranked = np.argsort(-giver.fill + random.random(len(giver.fill)), kind="stable")
    well = ranked[: max(1, len(ranked) // 2)]
    taken = np.zeros(len(giver.fill), bool)
    taken[random.choice(well, max(1, len(well) // 8), replace=False)] = True
    injected = taken[giver.bins]
    hit = np.zeros(len(receiver.fill), bool)
    hit[receiver.bins[injected]] = True
    # a mutation of the same kind: the worst sequences are opened too
    hit[np.argsort(receiver.fill, kind="stable")[: 1 + len(receiver.fill) // 50]] = True
    displaced = np.flatnonzero(hit[receiver.bins] & ~injected)
    n = len(receiver.fill)
    bins = np.where(injected, n + giver.bins, receiver.bins)
    fill = [*np.where(hit, receiver.capacity, receiver.fill).tolist(), *np.where(taken, giver.fill, giver.capacity).tolist()]
    order = displaced[np.argsort(-receiver.lengths[displaced], kind="stable")]
    best_fit(order, bins, fill, receiver.lengths, receiver.capacity)
    return Packing(bins, receiver.lengths, receiver.capacity)


def least_sequences(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound: of pieces beyond half a sequence no two meet, and the room that the largest leave is lost to what exceeds it.

    For every ``small``, pieces over ``capacity - small`` are alone among the pieces that are not below ``small``.
    """
    counts = np.bincount(lengths, minlength=capacity + 1)
    above = np.concatenate([np.cumsum(counts[::-1])[::-1], [0]])  # pieces of at least this length
    ids = np.concatenate([np.cumsum((counts * np.arange(capacity + 1))[::-1])[::-1], [0]])
    small = np.arange(capacity // 2 + 1)
    alone = above[capacity - small + 1]
    large = above[capacity // 2 + 1] - alone
    middling = ids[small] - ids[capacity - small + 1]
    return int((alone + np.maximum(large, -(-middling // capacity))).max()) if len(lengths) else 0


def evolve(lengths: np.ndarray, elites: list[np.ndarray], capacity: int, seed: int) -> Packing:
    """One epoch of an island: the elites it was given and new packings, crossed again and again."""
    random = np.random.default_rng(seed)
    least = least_sequences(lengths, capacity)
    population = [Packing(bins, lengths, capacity) for bins in elites]
    while len(population) < POPULATION:
        population.append(first_packing(lengths, capacity, random, 0.02 * len(population)))
        if len(population[-1].fill) == least:
            return population[-1]
    for _ in range(CROSSOVERS):
        population.sort(key=Packing.score, reverse=True)
        if len(population[0].fill) == least:
            break
        one, other = random.choice(len(population), 2, replace=False)
        child = crossover(population[one], population[other], random)
        if child.score() > population[-1].score():
            population[-1] = child
    return max(population, key=Packing.score)


def _epoch(pieces: DataFrame, elites: DataFrame | None, capacity: int, epoch: int) -> DataFrame:
    """``shard, island, uid, length, bin``: the best packing of every island. An island gets its own and its neighbour's."""
    islands = F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island")
    if elites is None:
        given = pieces.select("shard", islands, "uid", "length", F.lit(-1).alias("origin"), F.lit(0).cast("bigint").alias("bin"))
    else:
        given = elites.select("shard", F.explode(F.array_distinct(F.array("island", (F.col("island") + 1) % ISLANDS))).alias("to"), "uid", "length", F.col("island").alias("origin"), "bin")
        given = given.withColumnRenamed("to", "island")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        shard, island = int(frame["shard"].iloc[0]), int(frame["island"].iloc[0])
        parts = [part.sort_values("uid") for _, part in frame.groupby("origin")]
        base = parts[0]
        best = evolve(base["length"].to_numpy(), [part["bin"].to_numpy() for part in parts] if epoch else [], capacity, hash((shard, island, epoch)) & 0xFFFFFFFF)
        return pd.DataFrame({"shard": shard, "island": island, "uid": base["uid"], "length": base["length"], "bin": best.bins})

    return given.groupBy("shard", "island").applyInPandas(run, "shard bigint, island int, uid bigint, length int, bin bigint")


def _best(elites: DataFrame, capacity: int) -> DataFrame:
    """``uid, length, shard, bin, offset, filled`` in the best packing of each shard."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        islands = [part.sort_values("uid") for _, part in frame.groupby("island")]
        found = [Packing(part["bin"].to_numpy(), part["length"].to_numpy(), capacity) for part in islands]
        best = max(range(len(found)), key=lambda n: found[n].score())
        part, packing = islands[best].assign(bin=found[best].bins), found[best]
        offset = part.groupby("bin")["length"].cumsum() - part["length"]
        return pd.DataFrame({
            "uid": part["uid"], "length": part["length"], "shard": part["shard"], "bin": part["bin"],
            "offset": offset, "filled": packing.fill[part["bin"].to_numpy()] >= FILLED * capacity,
        })

    return elites.groupBy("shard").applyInPandas(run, "uid bigint, length int, shard bigint, bin bigint, offset bigint, filled boolean")


def _dealt(rest: DataFrame, shards: int) -> DataFrame:
    """``shard, uid, length``: pieces dealt in the order of their lengths, so that all shards get the like of every length."""
    if shards == 1:
        return rest.select(F.lit(0).cast("bigint").alias("shard"), "uid", "length")
    ordered = rest.repartitionByRange("length", "uid").sortWithinPartitions("length", "uid")
    place = F.monotonically_increasing_id()  # partition in the upper bits, place in it in the lower 33
    turn = place.bitwiseAND(F.lit((1 << 33) - 1)) + F.pmod(F.xxhash64(F.shiftright(place, 33)), F.lit(shards))
    return ordered.select(F.pmod(turn, F.lit(shards).cast("bigint")).alias("shard"), "uid", "length")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``uid, sequence_id, offset`` for pieces ``uid`` (distinct) and ``length`` (1 to ``capacity``)."""
    whole = pieces.where(F.col("length") == capacity)
    placed = whole.select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest, level = stored(pieces.where(F.col("length") < capacity).select("uid", "length"), "pieces"), 0
    count, sequences, before = rest.count(), None, None
    while count:
        shards = max(1, -(-count // SHARD))
        dealt = _dealt(rest, shards)
        elites = None
        for epoch in range(EPOCHS):
            elites = stored(_epoch(dealt, elites, capacity, epoch), "elites")
        best = stored(_best(elites, capacity), "packed")
        number = F.shiftleft(F.lit(level).cast("bigint"), 48) + F.shiftleft("shard", 20) + F.col("bin")
        best = best.withColumn("sequence_id", number)
        # every sequence has one piece at its beginning
        begins = F.col("offset") == 0
        needed, filled, open_pieces = best.agg(F.count_if(begins), F.count_if(begins & F.col("filled")), F.count_if(~F.col("filled"))).first()
        worse = sequences is not None and needed > sequences
        last = shards == 1 or worse or (count - open_pieces < PROGRESS * count and sequences is not None and sequences - needed < PROGRESS * needed)
        done = before if worse else best if last else best.where("filled")
        placed = placed.union(done.select("uid", "sequence_id", "offset"))
        if last:
            break
        before = best.where("NOT filled")
        rest, sequences, count, level = before.select("uid", "length"), needed - filled, open_pieces, level + 1
    return placed


def pieces_of(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``id`` (as text), ``piece, start, length, ids_crc32`` of every piece; only the first piece of a cut text is short."""
    definition = share_definition(docs.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = library_table(definition.value)
        for frame in frames:
            found = []
            for key, ids in zip(frame["id"], table.encode_each(texts_of(frame["text"])), strict=True):
                data, n = np.append(ids, end_id).astype("<u4"), len(ids) + 1
                first = n % capacity or capacity
                for piece, end in enumerate(range(first, n + 1, capacity)):
                    start = 0 if piece == 0 else end - capacity
                    found.append((key, piece, start, end - start, zlib.crc32(data[start:end].tobytes())))
            yield pd.DataFrame(found, columns=["id", "piece", "start", "length", "ids_crc32"])

    return keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, piece int, start bigint, length int, ids_crc32 bigint")


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """``id_col, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every row.

    The tokenizer file is ``path``. The checksum is over the ids as little-endian unsigned 32-bit integers.
    """
    pieces = pieces_of(docs, path, id_col, text_col, capacity, end_id).withColumn("uid", F.monotonically_increasing_id())
    pieces = stored(pieces, "all-pieces")
    joined = pieces.join(pack(pieces.select("uid", "length"), capacity), "uid")
    key = F.col("id").cast(docs.schema[id_col].dataType).alias(id_col)
    return joined.select(key, "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", "sequence_id", "offset")
