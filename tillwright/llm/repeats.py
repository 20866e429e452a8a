"""Suffix-array dedup: a radix sort of all suffixes through ``width`` bytes, most significant digit first.

Two suffixes fall into one group to the end exactly when their first ``width`` bytes are equal, so the groups of
the last pass are the repeated windows. Digits are fingerprints, chosen so that a pass rules out as
much as it can:

1. The first digit of a suffix is the smallest fingerprint of the ``GRAM``-byte strings in its first ``width`` bytes. Equal
   windows have it equal and neighbouring suffixes mostly share it, so the pass sorts runs of suffixes instead of
   suffixes. A digit that occurs in one run only has no repeated window.
2. The second digit is the whole stretch that a run covers. Runs that agree in it repeat entirely; of each group one
   represents the others from here on.
3. Where a first digit has several different stretches, their suffixes are sorted singly by the fingerprint
   of all ``width`` bytes. Groups of up to ``TOGETHER`` stretches are sorted in one task, from the bytes of the stretches;
   larger ones are counted over all tasks, with partial sums before the shuffle.

Equal texts are taken as one before the sort (their windows count as repeated). Distinct texts are told apart by a
64-bit hash. Null texts are empty; texts shorter than ``width`` have no window. Repeated rows and keys, null keys and
other columns make no difference. Matches never cross texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.rows import keyed, rekeyed, release_unused, remove_folder, small_batches
from tillwright.llm.windows import Fingerprints, sliding_minimum
from tillwright.session import scratch_path, stored

WIDTH, GRAM = 400, 32
#: Stretches of one first digit that are sorted in one task; more are counted over all tasks.
TOGETHER = 2000
#: Suffixes that are sorted in one call, and bytes of a text that are fingerprinted in one call.
AT_ONCE, PIECE = 500_000, 1 << 19
_PLACE_BITS = 22


def runs_of(data: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """First digit, second digit, first suffix and number of suffixes of each run of a text."""
    found = []
    for begin in range(0, max(0, len(data) - width + 1), PIECE):
        piece = data[begin : begin + PIECE + width - 1]
        grams = Fingerprints(piece, 0).windows(GRAM)
        place = np.uint64((1 << _PLACE_BITS) - 1)
        # the leftmost of the smallest: places break ties, equal windows break them alike
        smallest = sliding_minimum((grams & ~place) | np.arange(len(grams), dtype=np.uint64), width - GRAM + 1) & place
        first = np.flatnonzero(np.concatenate([[True], smallest[1:] != smallest[:-1]]))
        ends = np.concatenate([first[1:], [len(smallest)]])
        stretches = Fingerprints(piece, 1).of(first, ends - 1 + width)
        found.append((grams[smallest[first].astype(np.int64)], stretches, first + begin, ends - first))
    if not found:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    return tuple(np.concatenate(parts) for parts in zip(*found, strict=True))


def _runs(texts: DataFrame, width: int) -> DataFrame:
    """One row per run. ``place`` holds the first suffix, the number of suffixes and whether the text has a copy."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_unused()
        for frame in frames:
            parts, size = [], 0
            for key, text, copies in zip(frame["key"], frame["text"], frame["copies"], strict=True):
                data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                digit, stretch, first, count = runs_of(data, width)
                place = (first << 11) | (count << 1) | int(copies > 1)
                parts.append((digit.view(np.int64), stretch.view(np.int64), np.full(len(digit), key), place))
                size += len(digit)
                if size > 200_000:
                    yield framed(parts)
                    parts, size = [], 0
            if parts:
                yield framed(parts)

    def framed(parts: list[tuple[np.ndarray, ...]]) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("digit", "stretch", "key", "place"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    if not GRAM <= width < 1 << 10:
        raise ValueError(f"a window has {GRAM} to {(1 << 10) - 1} bytes")
    return texts.where(F.octet_length("text") >= width).mapInPandas(run, "digit bigint, stretch bigint, key bigint, place bigint")


def _repeated(groups: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether another suffix of the same group has the same window."""
    order = np.lexsort([windows, groups])
    same = (groups[order][1:] == groups[order][:-1]) & (windows[order][1:] == windows[order][:-1])
    found = np.zeros(len(order), bool)
    found[order[1:]] |= same
    found[order[:-1]] |= same
    return found


def _suffixes(spans: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Span, place and fingerprint of every window of the spans."""
    lengths = np.fromiter(map(len, spans), np.int64, len(spans))
    starts = np.cumsum(lengths) - lengths
    counts = lengths - width + 1
    owner = np.repeat(np.arange(len(spans)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = starts[owner] + offset
    return owner, offset, Fingerprints(np.frombuffer(b"".join(spans), np.uint8), 1).of(at, at + width)


def _bounds(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray) -> pd.DataFrame:
    """Runs of flagged suffixes of each owner as first and last offset."""
    owner, offset = owner[flags], offset[flags]
    begins = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)])[: len(owner)]
    ends = np.concatenate([begins[1:], [True]])[: len(owner)]
    return pd.DataFrame({"owner": owner[begins], "first": offset[begins], "last": offset[ends]})


def _sorted_together(spans: DataFrame, width: int) -> DataFrame:
    """Repeated suffixes of stretches whose whole group meets in one task: ``key, first, last`` window."""

    def solved(frame: pd.DataFrame) -> pd.DataFrame:
        owner, offset, windows = _suffixes(list(frame["span"]), width)
        found = _bounds(_repeated(frame["digit"].to_numpy()[owner], windows), owner, offset)
        of = frame.iloc[found["owner"]]
        begin = of["place"].to_numpy() >> 11
        return pd.DataFrame({"key": of["key"].to_numpy(), "first": begin + found["first"], "last": begin + found["last"]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for frame in frames:
            held.append(frame)
            size += int(frame["span"].map(len).sum())
            if size >= AT_ONCE:  # all but the last group are complete
                rows = pd.concat(held)
                last = rows["digit"] == rows["digit"].iloc[-1]
                if not last.all():
                    yield solved(rows[~last])
                held = [rows[last]]
                size = int(held[0]["span"].map(len).sum())
        if held and len(rows := pd.concat(held)):
            yield solved(rows)

    ordered = spans.repartition("digit").sortWithinPartitions("digit")
    return ordered.mapInPandas(run, "key bigint, first bigint, last bigint")


def _counted_apart(spans: DataFrame, width: int) -> DataFrame:
    """The same for groups of any size: windows are counted over all tasks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), 2000):
                part = frame.iloc[begin : begin + 2000]
                owner, offset, windows = _suffixes(list(part["span"]), width)
                of = part.iloc[owner]
                yield pd.DataFrame({
                    "digit": of["digit"].to_numpy(), "window": windows.view(np.int64), "key": of["key"].to_numpy(),
                    "first": (of["place"].to_numpy() >> 11) + offset,
                })

    suffixes = stored(spans.mapInPandas(run, "digit bigint, window bigint, key bigint, first bigint"), "suffixes")
    often = stored(suffixes.groupBy("digit", "window").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "windows")
    return suffixes.join(often, ["digit", "window"]).select("key", "first", F.col("first").alias("last"))


def _with_spans(stretches: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """The bytes of each stretch, cut from its text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for begin in range(0, len(frame), 500):
                part, spans = frame.iloc[begin : begin + 500], []
                for text, places in zip(part["text"], part["places"], strict=True):
                    data = text.encode("utf-8", "surrogatepass")
                    spans += [data[place >> 11 : (place >> 11) + (place >> 1 & 1023) + width - 1] for place in places.tolist()]
                yield pd.DataFrame({
                    "digit": np.concatenate(list(part["digits"])), "key": np.repeat(part["key"].to_numpy(), part["places"].map(len)),
                    "place": np.concatenate(list(part["places"])), "span": spans,
                })

    lists = F.sort_array(F.collect_list(F.struct("digit", "place")))
    per_text = stretches.groupBy("key").agg(lists.alias("found")).select("key", F.col("found.digit").alias("digits"), F.col("found.place").alias("places"))
    rows = per_text.join(texts.select("key", "text"), "key").select("key", "text", "digits", "places")
    return rows.mapInPandas(run, "digit bigint, key bigint, place bigint, span binary")


def _repeats(texts: DataFrame, width: int) -> DataFrame:
    """``key, first, last``: runs of suffixes whose windows occur elsewhere, in any order, some twice."""
    copied = F.col("place").bitwiseAND(F.lit(1))
    runs = _runs(texts, width)
    again = stored(
        runs.groupBy("digit").agg(F.sum(copied + 1).alias("n")).where("n > 1").select("digit"), "repeated-digits"
    )
    left = stored(runs.join(again, "digit"), "runs-left")
    kinds = stored(
        left.groupBy("digit", "stretch").agg(F.sum(copied + 1).alias("n"), F.min(F.struct("key", "place")).alias("one")), "stretches"
    )
    several = stored(kinds.groupBy("digit").agg(F.count("*").alias("kinds")).where("kinds > 1"), "several")
    # what repeats as a whole repeats in all its places; a stretch that stands alone has only one
    begin, count = F.shiftright("place", 11), F.shiftright("place", 1).bitwiseAND(F.lit(1023))
    whole = left.join(kinds.where("n > 1").select("digit", "stretch"), ["digit", "stretch"]).select("key", begin.alias("first"), (begin + count - 1).alias("last"))
    large = several.where(F.col("kinds") > TOGETHER)

    def spans(digits: DataFrame) -> DataFrame:
        return _with_spans(kinds.join(digits, "digit").select("digit", "one.key", "one.place"), texts, width)

    found = whole.union(_sorted_together(spans(several.where(F.col("kinds") <= TOGETHER)), width))
    return found if large.isEmpty() else found.union(_counted_apart(spans(large), width))


def _cut(docs: DataFrame, text_col: str, width: int, made: Callable[[bytes, list[tuple[int, int]]], dict], schema: str) -> DataFrame:
    """What ``made`` returns for each distinct text and its repeated byte ranges, under the hash of the text."""
    spark = docs.sparkSession
    folder, table = scratch_path(spark, "texts"), scratch_path(spark, "texts").rpartition("/")[2].replace("-", "_")
    column = docs.select(F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"))
    distinct = column.groupBy(F.xxhash64("text").alias("key")).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # texts are dealt out by their hash once; all joins with them move only the other side
    distinct.write.bucketBy(buckets, "key").option("path", folder).option("compression", "zstd").saveAsTable(table)
    texts = spark.table(table)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, text, copies, first, last in frame.itertuples(index=False):
                data = text.encode("utf-8", "surrogatepass")
                ranges = [(0, len(data))] if copies > 1 and len(data) >= width else _merged(first, last, width)
                rows.append({"key": key} | made(data, ranges))
            yield pd.DataFrame(rows)

    with small_batches(spark):
        found = _repeats(texts, width).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("found"))
        rows = texts.join(found, "key", "left").select("key", "text", "copies", "found.first", "found.last")
        result = stored(rows.mapInPandas(run, "key bigint, " + schema), "cut")
    spark.sql(f"DROP TABLE {table}")
    remove_folder(spark, folder)
    return result


def _merged(first: np.ndarray | None, last: np.ndarray | None, width: int) -> list[tuple[int, int]]:
    """Byte ranges covered by the windows from ``first`` to ``last``, overlapping and touching ones joined."""
    if first is None or not len(first):
        return []
    order = np.argsort(first, kind="stable")
    starts, ends = first[order], np.maximum.accumulate(last[order] + width)
    opens = np.concatenate([[True], starts[1:] > ends[:-1]])
    closes = np.concatenate([opens[1:], [True]])
    return list(zip(starts[opens].tolist(), ends[closes].tolist(), strict=True))


def _kept(data: bytes, ranges: list[tuple[int, int]]) -> bytes:
    ends = [0, *(end for _, end in ranges)]
    return b"".join(data[a:b] for a, b in zip(ends, [*(start for start, _ in ranges), len(data)], strict=True))


def repeat_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``id_col, n_bytes, n_removed, n_spans, kept_sha256`` and ``spans`` (removed byte ranges) of every row."""

    def made(data: bytes, ranges: list[tuple[int, int]]) -> dict:
        return {
            "n_bytes": len(data), "n_removed": sum(end - start for start, end in ranges), "n_spans": len(ranges),
            "kept_sha256": hashlib.sha256(_kept(data, ranges)).hexdigest(), "spans": ranges,
        }

    schema = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    cut = _cut(docs, text_col, width, made, schema)
    rows = keyed(docs, id_col, text=text_col).select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    return rekeyed(rows.join(cut, "key").drop("key"), docs, id_col)


def without_repeats(docs: DataFrame, text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """All rows and columns, the texts without their repeated bytes; a character cut in two goes entirely."""

    def made(data: bytes, ranges: list[tuple[int, int]]) -> dict:
        return {"kept_text": _kept(data, ranges).decode("utf-8", "ignore")}

    cut = _cut(docs, text_col, width, made, "kept_text string")
    text = docs[f"`{text_col}`"]
    others = [docs[f"`{name}`"].alias(f"c{n}") for n, name in enumerate(docs.columns) if name != text_col]
    rows = docs.select(F.xxhash64(F.coalesce(text, F.lit(""))).alias("key"), text.isNotNull().alias("has_text"), *others)
    kept = F.when(F.col("has_text"), F.col("kept_text"))
    return rows.join(cut, "key").select(
        *((kept if name == text_col else F.col(f"c{n}")).alias(name) for n, name in enumerate(docs.columns))
    )
