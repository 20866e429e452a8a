"""BPE, token files and packing against the tokenizers library and exact round trips."""

import hashlib
import heapq
import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillwright.llm import bpe, packing, token_files, tokens
from tillwright.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as file:
    DEFINITION = file.read()
PARTS = ["a", "the", " the", " ", "  ", "\n", "\r\n", "\t", "'s", "'", "é", "ß", "中文", "1", "23", "!", "..", "<|endoftext|>", "\x85", "\xa0", " ",
         "\x1c", "​", "😀", "é", "İ", "xxxxx", "²", "Ⅷ", "_", "\x00", "aaaa", "stupid", ".\nWorld"]
TEXTS = ["", "one two", "  lead and trail  ", "a" * 3000, "word " * 3000, "No<|endoftext|>w", "tabs\tand\n\n lines", "naïve café ñandú 中文 😀"]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, text, "x", 1) for n, text in enumerate(TEXTS)] + [(90, None, "x", 2), (None, "no key", "x", 3), (91, "same", "x", 4), (91, "same", "x", 4)]
    # extra columns with names that the operators use themselves
    return spark.createDataFrame(rows, "doc_id bigint, text string, id string, n int").repartition(3)


@pytest.mark.parametrize("build", [tokens.library_table, lambda definition: bpe.Codec(definition).table])
def test_ids_equal_the_library(build):
    table, rng = build(DEFINITION), random.Random(7)
    texts = TEXTS + ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(3000)]
    assert [ids.tolist() for ids in table.encode_each(texts)] == [ids_of(text) for text in texts]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text_round_trips(text):
    codec = bpe.codec_of(DEFINITION)
    ids = next(codec.table.encode_each([text]))
    assert ids.tolist() == ids_of(text)
    assert codec.rules.decode(ids) == text


def test_decoding_any_ids_equals_the_library():
    rng, rules = random.Random(1), bpe.MergeRules(DEFINITION)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert rules.decode(np.array(ids, np.int64)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_a_full_table_forgets_and_stays_right(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_PIECES", 60)
    monkeypatch.setattr(tokens, "STRETCH", 500)
    table, rng = bpe.Codec(DEFINITION).table, random.Random(2)
    texts = [" ".join(rng.choices(["".join(rng.choices("abcde", k=3)) for _ in range(9)] + ["the", "of"], k=20)) for _ in range(200)]
    assert [ids.tolist() for ids in table.encode_each(texts)] == [ids_of(text) for text in texts]
    assert table.n < 300


def test_other_kinds_of_tokenizers_are_refused():
    definition = json.loads(DEFINITION)
    definition["normalizer"] = {"type": "Lowercase"}
    with pytest.raises(ValueError):
        tokens.check_kind(json.dumps(definition))


def test_encode_decode_and_digests(spark, docs):
    expected = sorted(((row["doc_id"], ids_of(row["text"])) for row in docs.collect()), key=str)
    encoded = bpe.encode(docs, PATH)
    assert sorted(((row["doc_id"], row["ids"]) for row in encoded.collect()), key=str) == expected
    texts = sorted((row["doc_id"], row["text"]) for row in bpe.decode(encoded, PATH).collect() if row["doc_id"] is not None)
    assert texts == sorted((row["doc_id"], row["text"] or "") for row in docs.collect() if row["doc_id"] is not None)
    digests = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip_digests(docs, PATH).collect()}
    assert digests == {
        (row["doc_id"], len(ids_of(row["text"])), hashlib.sha256(np.array(ids_of(row["text"]), "<u4").tobytes()).hexdigest(),
         hashlib.sha256((row["text"] or "").encode()).hexdigest())
        for row in docs.collect()
    }
    assert bpe.round_trip_digests(docs.limit(0), PATH).collect() == []


def plain_huffman_cost(counts):
    heap = [int(n) for n in counts if n]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=2, max_size=60).filter(lambda counts: sum(map(bool, counts)) > 1))
def test_code_lengths_are_best(counts):
    counts = np.array(counts)
    free, short = token_files.code_lengths(counts, 30), token_files.code_lengths(counts, 6)
    assert (free * counts).sum() == plain_huffman_cost(counts)
    assert short.max() <= 6
    for lengths in (free, short):
        assert sum(2.0 ** -int(n) for n in lengths if n) == 1
        assert ((lengths > 0) == (counts > 0)).all()


def test_blocks_decode_by_themselves():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.geometric(0.01, 5000) - 1, 700)
    code = token_files.HuffmanCode(token_files.code_lengths(np.bincount(ids)))
    counts = np.array([1, 1999, 512, 2488])
    bits, starts = code.encode(ids, counts)
    begin = 0
    for data, blocks, n in zip(bits, starts, counts, strict=True):
        sizes = np.minimum(token_files.BLOCK, n - np.arange(len(blocks)) * token_files.BLOCK)
        assert (code.decode(data, blocks, sizes) == ids[begin : begin + n]).all()
        assert (code.decode(data, blocks[-1:], sizes[-1:]) == ids[begin + n - sizes[-1] : begin + n]).all()
        begin += n


def test_one_id_and_no_id():
    code = token_files.HuffmanCode(token_files.code_lengths(np.array([0, 5])))
    bits, starts = code.encode(np.array([1, 1, 1]), np.array([3]))
    assert code.decode(bits[0], starts[0], np.array([3])).tolist() == [1, 1, 1]
    assert token_files.code_lengths(np.zeros(0, np.int64)).tolist() == []
    with pytest.raises(ValueError):
        token_files.code_lengths(np.ones(5), 2)


@pytest.mark.parametrize("small", [True, False])
def test_token_files(spark, docs, monkeypatch, small):
    if small:  # many files and segments
        monkeypatch.setattr(token_files, "FILE_IDS", 2000)
        monkeypatch.setattr(token_files, "SEGMENT_IDS", 500)
    folder = scratch_path(spark, "store")
    token_files.write(docs, PATH, folder)
    rows = sorted(docs.collect(), key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0))
    start, expected = 0, []
    for row in rows:
        ids = [*ids_of(row["text"]), 0]
        expected.append((row["doc_id"], start, ids))
        start += len(ids)
    found = sorted((row["start"], row["doc_id"], row["ids"]) for row in token_files.read(spark, folder).collect())
    assert [(key, begin, ids) for begin, key, ids in found] == expected
    sums = sorted((row["start"], row["n_tokens"], row["ids_crc32"]) for row in token_files.digests(spark, folder).collect())
    assert sums == [(begin, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for _, begin, ids in expected]


def test_an_empty_store(spark, docs):
    folder = scratch_path(spark, "store")
    token_files.write(docs.limit(0), PATH, folder)
    assert token_files.digests(spark, folder).collect() == []


def check_packing(rows, docs, capacity):
    by_doc, by_sequence = {}, {}
    for row in rows:
        by_doc.setdefault(row["doc_id"], []).append(row)
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    for parts in by_sequence.values():
        place = 0
        for row in sorted(parts, key=lambda row: row["offset"]):
            assert row["offset"] == place
            place += row["length"]
        assert place <= capacity
    for doc in docs:
        ids = [*ids_of(doc["text"]), 0]
        parts = sorted(by_doc[doc["doc_id"]], key=lambda row: row["piece"])
        copies = sum(other["doc_id"] == doc["doc_id"] for other in docs)
        first = len(ids) % capacity or capacity
        bounds = [0, *range(first, len(ids) + 1, capacity)]
        expected = [(n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
        assert sorted(expected * copies) == sorted((row["piece"], row["start"], row["length"], row["ids_crc32"]) for row in parts)
    return len(by_sequence)


def test_packing(spark, docs):
    rows = packing.packed(docs, PATH, capacity=64).collect()
    n = check_packing(rows, docs.collect(), 64)
    assert n == -(-sum(row["length"] for row in rows) // 64)
    assert packing.packed(docs.limit(0), PATH).collect() == []


def test_packing_on_levels(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 60)
    rng = random.Random(5)
    lengths = [rng.randint(1, 100) for _ in range(700)]
    pieces = spark.createDataFrame(list(enumerate(lengths)), "uid bigint, length int")
    rows = packing.pack(pieces, 100).collect()
    fill = {}
    for row in rows:
        fill[row["sequence_id"]] = fill.get(row["sequence_id"], 0) + lengths[row["uid"]]
    assert sorted(row["uid"] for row in rows) == list(range(700))
    assert max(fill.values()) <= 100
    assert len(fill) <= 1.03 * sum(lengths) / 100 + 1


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 90, 400)
    one, other = (packing.first_packing(lengths, 100, rng, disorder) for disorder in (0.0, 0.5))
    for _ in range(20):
        child = packing.crossover(one, other, rng)
        assert len(child.bins) == 400
        assert child.fill.max() <= 100
        assert child.fill.sum() == lengths.sum()
        assert (np.bincount(child.bins, lengths) == child.fill).all()
        one = max(one, child, key=packing.Packing.score)
    assert len(packing.evolve(lengths, [one.bins, other.bins], 100, 1).fill) <= min(len(one.fill), len(other.fill))


def test_pieces_that_one_call_cannot_take(monkeypatch):
    monkeypatch.setattr(tokens, "LONG_PIECE", 20)
    table = tokens.library_table(DEFINITION)
    texts = ["x" * 50 + " short " + "y" * 30, f"a{tokens.MARK}b", tokens.MARK, "\n" * 60 + "end", "", "plain words"]
    assert [ids.tolist() for ids in table.encode_each(texts)] == [ids_of(text) for text in texts]


def test_least_number_of_sequences():
    bound = packing.least_sequences
    assert bound(np.array([], np.int64), 100) == 0
    assert bound(np.array([51] * 7), 100) == 7
    assert bound(np.array([60, 60, 60, 50, 50, 50]), 100) == 5
    assert bound(np.array([50] * 5 + [1]), 100) == 3


@pytest.mark.parametrize("kind", ["uniform", "over-half", "thirds"])
def test_packing_on_levels_is_as_good_as_one_best_fit(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "SHARD", 4000)
    rng = np.random.default_rng(5)
    lengths = {
        "uniform": rng.integers(1, 2048, 12_000),
        "over-half": np.concatenate([rng.integers(1025, 1400, 8000), rng.integers(300, 1000, 3000)]),
        "thirds": rng.integers(560, 760, 12_000),
    }[kind]
    rows = spark.createDataFrame([(n, int(length)) for n, length in enumerate(lengths)], "uid bigint, length int").repartition(3)
    placed = packing.pack(rows).join(rows, "uid").collect()
    assert sorted(row["uid"] for row in placed) == list(range(len(lengths)))
    sequences = {}
    for row in placed:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for pieces in sequences.values():
        ends = np.cumsum([0, *(length for _, length in sorted(pieces))])
        assert [offset for offset, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= 2048
    fill: list[int] = []
    packing.best_fit(np.argsort(-lengths, kind="stable"), np.zeros(len(lengths), np.int64), fill, lengths, 2048)
    assert packing.least_sequences(lengths, 2048) <= len(sequences) <= len(fill)
    if kind == "thirds":  # crossover finds what best fit does not
        assert len(sequences) < len(fill)
