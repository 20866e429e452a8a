"""Two tokenizers' ids of the same texts, aligned where both end a token at the same byte.

A text is encoded by a byte-level BPE (A, of space and text) and by a sentencepiece model (B, of the text; it adds the
space itself), special tokens being plain text. Offsets at which tokens of both end cut the bytes into groups; inside a
group every A token is linked with every B token. The count of an id pair is the number of rows that hold it linked.

The fast path is an array that gives each A id the B id of the same bytes. Such pairs, nearly all groups of one token
each, are counted in one vector of vocabulary length per task; only other pairs enter the shuffle, once per
block of texts with the number of its rows that hold them. Each block gets its pairs' counts back, one row per pair, so
neither a frequent pair nor a hot source makes a large group: a block is at most ``BLOCK_CHARS`` of text or one longer
text. What comes to the driver are two numbers per A id.

Null or empty texts, and texts whose tokens don't join to their bytes on either side (a model that drops or rewrites
characters), have no tokens: zeros and an empty string. Rows count as texts of their own, whatever their key; null keys stay. Very
long texts are one block and are encoded whole; what they need is bounded by their tokens and distinct linked pairs.
Repeated rows count each. Empty tables give empty results. Only the two columns are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.rows import keyed, rekeyed, small_batches
from tillwright.llm.tokens import PATTERN, byte_ranks, check_kind, stretches, texts_of
from tillwright.session import scratch_path

#: Characters and distinct pairs after which a block of texts is closed.
BLOCK_CHARS, BLOCK_PAIRS = 4_000_000, 200_000
#: Pairs of a stretch of text that are expanded together.
EXPANDED = 2_000_000
#: Texts of this many characters are encoded by the tokenizers library: tiktoken's pattern fails on a million blanks in a row.
LONG = 200_000

STORED = (
    "kind string, block string, id string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "same_ids binary, same_links binary, slots binary, slot_links binary, a array<int>, b array<int>, rows array<bigint>"
)
_COLUMNS = [part.split()[0] for part in STORED.split(", ")]
_DIGESTS = "id string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


class Aligner:
    """Both tokenizers, the bytes of their tokens and the array of ids with the same bytes (-1 without one)."""

    def __init__(self, definition: str, model: bytes):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        ranks = byte_ranks(definition)
        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = True
        self.first = tiktoken.Encoding("first", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, n in ranks.items():
            self.a_bytes[n] = token
        ids = range(self.second.vocab_size())
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.second.is_byte(n) else piece.replace("▁", " ").encode()
            for n, piece in zip(ids, map(self.second.id_to_piece, ids))
        ]
        odd = [self.second.is_unknown(n) or self.second.is_control(n) or self.second.is_unused(n) for n in ids]
        by_bytes = {self.b_bytes[n]: n for n in ids if self.second.is_byte(n)}
        by_bytes |= {self.b_bytes[n]: n for n in reversed(ids) if not self.second.is_byte(n) and not odd[n]}
        self.same = np.array([by_bytes.get(token, -1) for token in self.a_bytes], np.int64)
        self.a_sizes = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_sizes = np.array(list(map(len, self.b_bytes)), np.int64)
        # text of an id behind each of the marks that come before a token
        self.marks = (b";", b",", b"|")
        self.spelled = [mark + b"%d" % n for mark in self.marks for n in range(max(len(self.a_bytes), len(ids)))]

    def _encoded(self, texts: list[str]) -> tuple[list, list, np.ndarray]:
        """Ids on both sides of the texts that can be aligned, and their places."""
        a_ids, b_ids, places = [], [], []
        found = self.second.encode(texts, num_threads=1) if texts else []
        for place, (text, second) in enumerate(zip(texts, found)):
            spaced = " " + text
            data = spaced.encode("utf-8", "surrogatepass")
            if not text or b"".join(map(self.b_bytes.__getitem__, second)) != data:
                continue
            first = self.first.encode_ordinary(spaced) if len(text) < LONG else self.library.encode(spaced, add_special_tokens=False).ids
            if b"".join(map(self.a_bytes.__getitem__, first)) == data:
                a_ids.append(first)
                b_ids.append(second)
                places.append(place)
        return a_ids, b_ids, np.array(places, np.int64)

    def aligned(self, texts: list[str]) -> Alignments:
        """The groups of many texts at once, byte offsets running on from text to text."""
        a_ids, b_ids, places = self._encoded(texts)
        a, b = (np.fromiter(chain.from_iterable(side), np.int64, sum(map(len, side))) for side in (a_ids, b_ids))
        a_doc, b_doc = (np.repeat(places, list(map(len, side))) for side in (a_ids, b_ids))
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        ended = np.zeros((2, int(a_ends[-1]) + 1 if len(a) else 1), bool)
        ended[0, a_ends] = ended[1, b_ends] = True
        both = ended[0] & ended[1]
        a_last, b_last = both[a_ends], both[b_ends]
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        return Alignments(self, len(texts), a, b, a_doc, b_doc, a_group, b_group)


class Alignments:
    """Aligned ids of a list of texts."""

    def __init__(self, aligner: Aligner, n: int, a, b, a_doc, b_doc, a_group, b_group):
        self.aligner, self.n, self.a, self.b, self.a_group, self.b_group = aligner, n, a, b, a_group, b_group
        groups = int(a_group[-1]) + 1 if len(a) else 0
        self.a_in, self.b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        self.a_first, self.b_first = np.cumsum(self.a_in) - self.a_in, np.cumsum(self.b_in) - self.b_in
        self.doc = a_doc[self.a_first]
        self.n_a, self.n_b, self.n_groups = (np.bincount(x, minlength=n) for x in (a_doc, b_doc, self.doc))
        links = np.concatenate([[0], np.cumsum(self.a_in * self.b_in)])
        ends = np.cumsum(self.n_groups)
        self.n_links = links[ends] - links[ends - self.n_groups]

    def spelled(self) -> list[bytes]:
        """Each text's groups: ids of A, a bar, ids of B, groups parted by semicolons."""
        width = len(self.aligner.spelled) // 3
        total = len(self.a) + len(self.b)
        found = np.zeros(total, np.int64)
        before = np.cumsum(self.a_in + self.b_in) - self.a_in - self.b_in
        a_starts = np.arange(len(self.a)) == self.a_first[self.a_group]
        b_starts = np.arange(len(self.b)) == self.b_first[self.b_group]
        found[before[self.a_group] + np.arange(len(self.a)) - self.a_first[self.a_group]] = self.a + np.where(a_starts, 0, width)
        places = (before + self.a_in)[self.b_group] + np.arange(len(self.b)) - self.b_first[self.b_group]
        found[places] = self.b + np.where(b_starts, 2 * width, width)
        ends, spelled = np.cumsum(self.n_a + self.n_b), self.aligner.spelled
        return [b"".join(map(spelled.__getitem__, found[end - size : end].tolist()))[1:] for end, size in zip(ends, self.n_a + self.n_b)]

    def pairs(self) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
        """Distinct linked pairs of each text with their links: ``(doc, a, links)`` where B has the same bytes, ``(doc, a, b, links)`` else."""
        same, wide = self.aligner.same, len(self.aligner.b_bytes)
        plain = (self.a_in == 1) & (self.b_in == 1)
        plain[plain] = same[self.a[self.a_first[plain]]] == self.b[self.b_first[plain]]
        a_size = len(self.aligner.a_bytes)
        straight, straight_links = np.unique(self.doc[plain] * a_size + self.a[self.a_first[plain]], return_counts=True)
        left, left_times = np.unique((self.a_group * a_size + self.a)[~plain[self.a_group]], return_counts=True)
        right, right_times = np.unique((self.b_group * wide + self.b)[~plain[self.b_group]], return_counts=True)
        sizes = np.bincount(right // wide, minlength=len(self.a_in))
        starts = np.cumsum(sizes) - sizes
        keys, links = np.zeros(0, np.int64), np.zeros(0, np.int64)
        upto = np.cumsum(sizes[left // a_size])
        begin = 0
        while begin < len(left):  # a slice of A tokens with all B tokens of their groups
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + EXPANDED, "right")))
            group, one, times = left[begin:end] // a_size, left[begin:end] % a_size, left_times[begin:end]
            many = sizes[group]
            last = np.cumsum(many)
            other = np.repeat(starts[group] - last + many, many) + np.arange(last[-1])
            made = (np.repeat(self.doc[group], many) * a_size + np.repeat(one, many)) * wide + right[other] % wide
            keys, links = _summed(np.concatenate([keys, made]), np.concatenate([links, np.repeat(times, many) * right_times[other]]))
            begin = end
        doc_a, b = keys // wide, keys % wide
        alike = same[doc_a % a_size] == b
        doc_same, same_links = _summed(np.concatenate([straight, doc_a[alike]]), np.concatenate([straight_links, links[alike]]))
        other = ~alike
        return (
            (doc_same // a_size, doc_same % a_size, same_links),
            (doc_a[other] // a_size, doc_a[other] % a_size, b[other], links[other]),
        )


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


_aligners: dict[int, Aligner] = {}


def _aligner(shared: Broadcast) -> Aligner:
    """One per worker process and pair of tokenizers."""
    key = hash(shared.value)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*shared.value)
    return _aligners[key]


def share_tokenizers(spark: SparkSession, a_path: str, b_path: str) -> Broadcast:
    """Both files for all tasks, a few MB by their vocabularies."""
    with open(a_path, encoding="utf-8") as file:
        definition = file.read()
    check_kind(definition)
    with open(b_path, "rb") as file:
        return spark.sparkContext.broadcast((definition, file.read()))


class _Block:
    """Texts whose pairs are sent together."""

    def __init__(self, name: str):
        self.name, self.chars = name, 0
        self.docs: list[dict] = []
        self.keys: list[np.ndarray] = []

    def add(self, found: Alignments, ids: list, whole: bool, vector: np.ndarray) -> None:
        (same_doc, same_a, same_links), (doc, a, b, links) = found.pairs()
        vector += np.bincount(same_a, minlength=len(vector))
        keys = a * len(found.aligner.b_bytes) + b
        same_cuts, cuts = np.searchsorted(same_doc, np.arange(found.n + 1)), np.searchsorted(doc, np.arange(found.n + 1))
        for n, (key, groups) in enumerate(zip(ids, found.spelled())):
            same, other = slice(same_cuts[n], same_cuts[n + 1]), slice(cuts[n], cuts[n + 1])
            told = groups.decode() if whole else hashlib.sha256(groups).hexdigest() if groups else ""
            self.docs.append({
                "id": key, "n_a": found.n_a[n], "n_b": found.n_b[n], "n_groups": found.n_groups[n], "n_links": found.n_links[n], "groups": told,
                "same_ids": same_a[same].astype("<i4").tobytes(), "same_links": same_links[same].astype("<i8").tobytes(),
                "slot_links": links[other].astype("<i8").tobytes(),
            })
            self.keys.append(keys[other])

    def rows(self, wide: int) -> pd.DataFrame:
        """One row per text and one with the block's distinct pairs and the number of its rows that hold them."""
        keys, slots, rows = np.unique(np.concatenate([np.zeros(0, np.int64), *self.keys]), return_inverse=True, return_counts=True)
        for doc, mine in zip(self.docs, np.split(slots, np.cumsum(list(map(len, self.keys)))[:-1])):
            doc["kind"], doc["slots"] = "text", mine.astype("<i4").tobytes()
        pairs = {"kind": "pairs", "a": (keys // wide).tolist(), "b": (keys % wide).tolist(), "rows": rows.tolist()}
        return pd.DataFrame([*self.docs, pairs], columns=_COLUMNS).assign(block=self.name)


def _clean(rows: pd.DataFrame) -> pd.DataFrame:
    """Absent values as None; counts as nullable integers."""
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        rows[name] = rows[name].astype("Int64")
    return rows.astype(object).where(rows.notna(), None) if len(rows) else rows


@dataclass
class Alignment:
    """What one pass over the texts has stored, and what follows from it.

    ``pair_counts``: ``a, b, rows`` for every pair of different bytes. ``same_counts``: ``a, rows`` for pairs of the same
    bytes. Both are as large as the vocabularies allow.
    """

    texts: DataFrame
    pairs: DataFrame
    pair_counts: DataFrame
    same_counts: DataFrame
    shared: Broadcast

    def counts(self) -> DataFrame:
        """``a, b, rows`` of all linked pairs."""
        shared = self.shared

        def named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.assign(b=_aligner(shared).same[batch["a"]])

        return self.pair_counts.union(self.same_counts.mapInPandas(named, "a int, rows bigint, b int").select("a", "b", "rows"))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = False) -> Alignment:
    """Encode and align all texts, store what is needed of them, and count the pairs.

    With ``whole`` the groups are kept as text, else only their SHA-256.
    """
    spark = docs.sparkSession
    shared = share_tokenizers(spark, a_path, b_path)

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = _aligner(shared)
        vector, wide = np.zeros(len(aligner.a_bytes), np.int64), len(aligner.b_bytes)
        part, number = TaskContext.get().partitionId(), 0
        block = _Block(f"{part}-0")
        for batch in batches:
            texts, ids, place = texts_of(batch["text"]), batch["id"].tolist(), 0
            for some in stretches(texts):
                block.add(aligner.aligned(some), ids[place : place + len(some)], whole, vector)
                place += len(some)
                block.chars += sum(map(len, some))
                if block.chars >= BLOCK_CHARS or sum(map(len, block.keys)) >= 8 * BLOCK_PAIRS:
                    yield _clean(block.rows(wide))
                    number += 1
                    block = _Block(f"{part}-{number}")
        if block.docs:
            yield _clean(block.rows(wide))
        held = np.flatnonzero(vector)
        if len(held):
            yield pd.DataFrame([{"kind": "same", "a": held.tolist(), "rows": vector[held].tolist()}], columns=_COLUMNS).astype(object).where(lambda x: x.notna(), None)

    path = scratch_path(spark, "aligned")
    with small_batches(spark, 500):
        keyed(docs, id_col, text=text_col).mapInPandas(blocks, STORED).write.parquet(path)
    stored = spark.read.schema(STORED).parquet(path)
    listed = stored.where("kind = 'pairs'").select("block", F.posexplode(F.arrays_zip("a", "b", "rows")).alias("slot", "pair"))
    pairs = listed.select("block", "slot", "pair.a", "pair.b", "pair.rows")
    vectors = stored.where("kind = 'same'").select(F.explode(F.arrays_zip("a", "rows")).alias("one")).select("one.a", "one.rows")
    count = F.sum("rows").alias("rows")
    return Alignment(stored.where("kind = 'text'"), pairs, _kept(pairs.groupBy("a", "b").agg(count)), vectors.groupBy("a").agg(count), shared)


def _kept(df: DataFrame) -> DataFrame:
    """Counts are used twice: once for the best of each id, once for the blocks."""
    path = scratch_path(df.sparkSession, "pair-counts")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scored(found: Alignment) -> DataFrame:
    """``id`` (as text), the sizes, ``n_best``, ``count_sum`` and ``groups`` of every row."""
    spark = found.texts.sparkSession
    # two numbers per id of A
    same = {row["a"]: row["rows"] for row in found.same_counts.collect()}
    best = {row["a"]: row["most"] for row in found.pair_counts.groupBy("a").agg(F.max("rows").alias("most")).collect()}
    size = 1 + max([0, *same, *best])
    vectors = np.zeros((2, size), np.int64)
    vectors[0, list(same)] = list(same.values())
    vectors[1, list(best)] = list(best.values())
    vectors[1] = vectors.max(axis=0)
    shared = spark.sparkContext.broadcast(vectors)

    def judged(texts: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        same_counts, best_counts = shared.value
        width = int(pairs["slot"].max()) + 1 if len(pairs) else 0
        counts, wins = np.zeros(width, np.int64), np.zeros(width, bool)
        slots = pairs["slot"].to_numpy(np.int64)
        counts[slots] = pairs["rows"].to_numpy(np.int64)
        wins[slots] = counts[slots] == best_counts[pairs["a"].to_numpy(np.int64)]
        sums, best = [], []
        for same_ids, same_links, mine, links in zip(texts["same_ids"], texts["same_links"], texts["slots"], texts["slot_links"]):
            one, slot = np.frombuffer(same_ids, "<i4"), np.frombuffer(mine, "<i4")
            straight, other = np.frombuffer(same_links, "<i8"), np.frombuffer(links, "<i8")
            sums.append(int(same_counts[one] @ straight + counts[slot] @ other))
            best.append(int(straight[same_counts[one] == best_counts[one]].sum() + other[wins[slot]].sum()))
        return texts.assign(n_best=best, count_sum=sums)[["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]]

    told = found.pairs.select("block", "slot", "a", "b").join(found.pair_counts, ["a", "b"]).select(F.col("block").alias("of"), "slot", "a", "rows")
    texts = found.texts.select("block", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "same_ids", "same_links", "slots", "slot_links")
    return texts.groupBy("block").cogroup(told.groupBy("of")).applyInPandas(judged, _DIGESTS)


def alignment_digests(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: key, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and ``groups_sha256``."""
    found = scored(aligned(docs, a_path, b_path, id_col, text_col)).withColumnRenamed("groups", "groups_sha256")
    return rekeyed(found, docs, id_col)


def aligned_groups(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: key and ``groups``, the aligned ids themselves as text."""
    return rekeyed(aligned(docs, a_path, b_path, id_col, text_col, whole=True).texts.select("id", "groups"), docs, id_col)
