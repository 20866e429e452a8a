"""Token ids in files: canonical length-limited Huffman code, blocks that decode independently.

A store is a folder with two Parquet datasets. ``code`` has the code length of every id; canonical
codes follow from the lengths alone. ``segments`` has one row per run of consecutive documents, in
ascending order of the document key: the keys, the number of ids of each document, the bits of
all their codes (each document begins on a byte), and the bit at which each block of ``BLOCK`` ids
begins, so that any block can be decoded without those before it.

Null texts are empty; every document has at least its end id. Rows with a null key come first,
repeated rows are written as often as they occur, in the order of their ids. An empty table gives a
store without segments. Other columns are not stored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwright.llm.rows import keyed, remove_folder
from tillwright.llm.tokens import library_table, share_definition, texts_of
from tillwright.session import scratch_path

#: Longest code in bits. The decoding table has 2 to this power entries; 25 is the most that a 32-bit window allows.
MAX_BITS = 18
#: Ids between two checkpoints, ids in a segment (one document may have more), ids in a file.
BLOCK, SEGMENT_IDS, FILE_IDS = 512, 400_000, 16_000_000
#: Files at most; beyond it they get longer. They are written and read segment by segment.
MAX_FILES = 4096


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of each id in the best code that has none longer than ``max_bits``; 0 for ids that never occur.

    Package-merge: on each level the ids and the pairs of the level below are sorted together by weight.
    """
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_bits} bits")
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    used = used[np.argsort(counts[used], kind="stable")]
    weights = counts[used].astype(np.int64)
    levels, items = [], weights
    for level in range(max_bits):
        leaf = np.ones(len(weights), bool)
        if level:
            pairs = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
            items = np.concatenate([weights, pairs])
            leaf = np.concatenate([leaf, np.zeros(len(pairs), bool)])
        order = np.argsort(items, kind="stable")
        items = items[order]
        levels.append(leaf[order])
    take = 2 * len(used) - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[used[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


class HuffmanCode:
    """Canonical code: shorter codes first, ids in order within a length."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        order = np.lexsort([np.arange(len(lengths)), lengths])
        order = order[lengths[order] > 0]
        self.bits = int(self.lengths.max(initial=1))
        # the codes laid side by side fill the table of all words of ``bits`` bits
        widths = np.int64(1) << (self.bits - self.lengths[order])
        firsts = np.cumsum(widths) - widths
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = firsts >> (self.bits - self.lengths[order])
        size = 1 << self.bits
        self.table_ids = np.resize(np.repeat(order, widths), size).astype(np.int32) if len(order) else np.zeros(size, np.int32)
        self.table_lengths = self.lengths[self.table_ids]

    def encode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
        """For documents of ``counts`` ids (none empty): the bits of each, and the bit at which each of its blocks begins."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        firsts = np.cumsum(counts) - counts
        before = (ends - lengths)[firsts]
        sizes = (np.diff(np.concatenate([before, ends[-1:]])) + 7) // 8
        begins = np.cumsum(sizes) - sizes
        within = ends - lengths - np.repeat(before, counts)
        starts = within + np.repeat(8 * begins, counts)
        words = np.zeros(int(sizes.sum()) // 8 + 2, np.uint64)
        word, room = starts >> 6, 64 - (starts & 63) - lengths
        codes = self.codes[ids]
        whole = np.where(room >= 0, codes << np.maximum(room, 0).astype(np.uint64), codes >> np.maximum(-room, 0).astype(np.uint64))
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        words[word[first]] = np.bitwise_or.reduceat(whole, first)
        over = np.flatnonzero(room < 0)  # at most one code runs over the end of a word
        words[word[over] + 1] |= codes[over] << (64 + room[over]).astype(np.uint64)
        data = words.astype(">u8").tobytes()
        blocks = within[(np.arange(len(ids)) - np.repeat(firsts, counts)) % BLOCK == 0]
        return (
            [data[begin : begin + size] for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True)],
            np.split(blocks, np.cumsum((counts + BLOCK - 1) // BLOCK)[:-1]),
        )

    def decode(self, payload: bytes, offsets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Ids of blocks that begin at the bit ``offsets`` and have ``counts`` ids; all blocks advance together."""
        data = np.frombuffer(payload + bytes(4), np.uint8).astype(np.uint32)
        window = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
        order = np.argsort(-counts, kind="stable")
        at, left = offsets[order].astype(np.int64), counts[order]
        firsts = (np.cumsum(counts) - counts)[order]
        ids = np.zeros(int(counts.sum()), np.int32)
        mask = (1 << self.bits) - 1
        for step in range(int(counts.max(initial=0))):
            live = int(np.searchsorted(-left, -step))
            at, firsts = at[:live], firsts[:live]
            entry = (window[at >> 3].astype(np.int64) >> (32 - self.bits - (at & 7))) & mask
            ids[firsts + step] = self.table_ids[entry]
            at = at + self.table_lengths[entry]
        return ids


def _pack(ids: np.ndarray) -> bytes:
    """Bytes of the ids, all lowest bytes first; the planes compress better than whole numbers."""
    return ids.astype("<u4").view(np.uint8).reshape(-1, 4).T[: _planes(ids)].tobytes()


def _planes(ids: np.ndarray) -> int:
    return max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)


def _unpack(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    ids = np.zeros((n, 4), np.uint8)
    ids[:, : len(planes)] = planes.T
    return ids.view("<u4")[:, 0].astype(np.int64)


def _batches(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """Rows of about ``SEGMENT_IDS`` ids with the ids of all of them."""
    group = (frame["n"].cumsum() // SEGMENT_IDS).to_numpy()
    cuts = [0, *np.flatnonzero(np.diff(group)) + 1, len(frame)]
    for begin, end in pairwise(cuts):
        if begin < end:
            rows = frame.iloc[begin:end]
            yield rows, np.concatenate([_unpack(data, n) for n, data in zip(rows["n"], rows["ids"], strict=True)])


def _store_ids(docs: DataFrame, path: str, id_col: str, text_col: str, end_id: int, folder: str) -> DataFrame:
    """Ids of every document with the end id, once, as scratch: each text is encoded a single time."""
    definition = share_definition(docs.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = library_table(definition.value)
        for frame in frames:
            sizes, packed = [], []
            for ids in table.encode_each(texts_of(frame["text"])):
                sizes.append(len(ids) + 1)
                packed.append(_pack(np.append(ids, end_id)))
            yield pd.DataFrame({"id": frame["id"].to_numpy(), "n": sizes, "ids": packed})

    keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, n int, ids binary").write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema("id string, n int, ids binary").parquet(folder)


def _count_ids(stored: DataFrame) -> np.ndarray:
    """How often each id occurs in all documents; one row per distinct id comes to the driver, a vocabulary at most."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(0, np.int64)
        for frame in frames:
            for _, ids in _batches(frame):
                found = np.bincount(ids, minlength=len(counts))
                found[: len(counts)] += counts
                counts = found
        yield pd.DataFrame({"token": np.flatnonzero(counts), "n": counts[counts > 0]})

    rows = stored.select("n", "ids").mapInPandas(run, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((row["token"] for row in rows), default=0) + 1, np.int64)
    for row in rows:
        counts[row["token"]] = row["n"]
    return counts


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> None:
    """Encode the texts with the tokenizer file ``path``, end each with ``end_id`` and write the store ``folder``.

    Texts are encoded once, in the order they are read, into scratch that goes when the store is written.
    Only coded documents are shuffled, into key ranges of about ``FILE_IDS`` ids.
    """
    spark = docs.sparkSession
    scratch = scratch_path(spark, "token-ids")
    kind = docs.schema[id_col].dataType.simpleString()
    stored = _store_ids(docs, path, id_col, text_col, end_id, scratch)
    counts = _count_ids(stored)
    lengths = code_lengths(counts)
    spark.createDataFrame(pd.DataFrame({"token": np.arange(len(lengths)), "bits": lengths}), "token int, bits int").coalesce(1).write.parquet(f"{folder}/code")
    files = int(min(MAX_FILES, max(1, counts.sum() // FILE_IDS)))
    bounds = stored.agg(F.percentile_approx(F.col("id").cast(kind), [n / files for n in range(1, files)] or [0.5], 100 * files)).first()[0] or []
    code = spark.sparkContext.broadcast(HuffmanCode(lengths))

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rows, ids in _batches(frame):
                bits, checkpoints = code.value.encode(ids, rows["n"].to_numpy(np.int64))
                yield rows[["id", "n"]].assign(bits=bits, checkpoints=checkpoints)

    def segment(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, start, seq, held = None, 0, 0, 0
        keys, sizes, payload, checkpoints = [], [], bytearray(), []

        def made() -> pd.DataFrame:
            row = {
                "bucket": bucket, "seq": seq, "start_in_bucket": start, "ids": keys, "sizes": sizes,
                "payload": bytes(payload), "checkpoints": np.concatenate(checkpoints),
            }
            return pd.DataFrame({name: [value] for name, value in row.items()})

        for frame in frames:
            for row in frame.itertuples(index=False):
                if keys and (row.bucket != bucket or held + row.n > SEGMENT_IDS):
                    yield made()
                    start, seq, held = start + held, seq + 1, 0
                    keys, sizes, payload, checkpoints = [], [], bytearray(), []
                if row.bucket != bucket:
                    bucket, start, seq = row.bucket, 0, 0
                keys.append(row.id)
                sizes.append(row.n)
                held += row.n
                checkpoints.append(np.asarray(row.checkpoints, np.int64) + 8 * len(payload))
                payload += row.bits
        if keys:
            yield made()

    key = F.col("id").cast(kind)
    smaller = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda bound: bound < key))
    bucket = F.coalesce(smaller, F.lit(0)) if files > 1 else F.lit(0)
    (
        stored.mapInPandas(encode, "id string, n int, bits binary, checkpoints array<bigint>")
        .withColumn("bucket", bucket.cast("int"))
        .repartitionById(files, F.col("bucket"))
        .sortWithinPartitions("bucket", key, "n", "bits")
        .mapInPandas(segment, "bucket int, seq int, start_in_bucket bigint, ids array<string>, sizes array<int>, payload binary, checkpoints array<bigint>")
        .write.option("compression", "none").parquet(f"{folder}/segments")
    )
    remove_folder(spark, scratch)


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments with the number of ids of all documents before them; sums meet in one task, one row per file,
    and are broadcast: there are ``MAX_FILES`` at most."""
    schema = "bucket int, seq int, start_in_bucket bigint, ids array<string>, sizes array<int>, payload binary, checkpoints array<bigint>"
    segments = spark.read.schema(schema).parquet(f"{folder}/segments")
    last = segments.groupBy("bucket").agg(F.max(F.expr("start_in_bucket + aggregate(sizes, 0L, (a, b) -> a + b)")).alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = last.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return segments.join(F.broadcast(bases), "bucket").withColumn("start", F.col("base") + F.col("start_in_bucket"))


def _decoded(row, code: HuffmanCode) -> Iterator[np.ndarray]:
    sizes = np.asarray(row.sizes, np.int64)
    blocks = (sizes + BLOCK - 1) // BLOCK
    counts = np.full(int(blocks.sum()), BLOCK, np.int64)
    counts[np.cumsum(blocks) - 1] = sizes - (blocks - 1) * BLOCK
    ids = code.decode(row.payload, np.asarray(row.checkpoints, np.int64), counts)
    return iter(np.split(ids, np.cumsum(sizes)[:-1]))


def _read_code(spark: SparkSession, folder: str):
    rows = spark.read.schema("token int, bits int").parquet(f"{folder}/code").toPandas().sort_values("token")
    return spark.sparkContext.broadcast(HuffmanCode(rows["bits"].to_numpy()))


def read(spark: SparkSession, folder: str, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """``id_col``, ``start`` (ids of all documents before it) and ``ids`` of every document of a store."""
    code = _read_code(spark, folder)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes = np.asarray(row.sizes, np.int64)
                yield pd.DataFrame({"id": row.ids, "start": row.start + np.cumsum(sizes) - sizes, "ids": list(_decoded(row, code.value))})

    rows = _segments(spark, folder).select("ids", "sizes", "payload", "checkpoints", "start")
    found = rows.mapInPandas(run, "id string, start bigint, ids array<int>")
    return found.select(F.col("id").cast(id_type).alias(id_col), "start", "ids")


def digests(spark: SparkSession, folder: str, id_col: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """Read a store back: ``id_col, start, n_tokens, ids_crc32`` of every document.

    The checksum is over the ids as little-endian unsigned 32-bit integers. Ids do not leave their task.
    """
    code = _read_code(spark, folder)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                sizes = np.asarray(row.sizes, np.int64)
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in _decoded(row, code.value)]
                yield pd.DataFrame({"id": row.ids, "start": row.start + np.cumsum(sizes) - sizes, "n_tokens": sizes, "ids_crc32": sums})

    rows = _segments(spark, folder).select("ids", "sizes", "payload", "checkpoints", "start")
    found = rows.mapInPandas(run, "id string, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.select(F.col("id").cast(id_type).alias(id_col), "start", "n_tokens", "ids_crc32")
