"""Byte-level BPE in batched merge rounds, and its inverse.

New pieces of many texts are cut into words by the tokenizer's pattern and laid out as bytes in one
flat array. A round looks up the rank of each neighbouring pair by binary search over the sorted
pair keys, merges in every word all places of its lowest-ranked pair, and lets go of the words
that have none left. Decoding copies the bytes of the ids from one table.

Nulls are encoded as the empty text and give no ids. Repeated rows give repeated results; other
columns are kept out. The length of a text or word is not limited.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tillwright.llm.rows import keyed, rekeyed
from tillwright.llm.tokens import PieceTable, by_words, byte_letters, share_definition, special_tokens, stretches, table_of, texts_of

_NONE = np.iinfo(np.int32).max


class MergeRules:
    """The vocabulary and merges of a byte-level BPE file as arrays."""

    def __init__(self, definition: str):
        model = json.loads(definition)["model"]
        vocabulary: dict[str, int] = model["vocab"]
        merges = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        letters = byte_letters()
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocabulary[letter]
        specials = special_tokens(definition)
        self.size = max([*vocabulary.values(), *specials.values()]) + 1
        keys = np.array([vocabulary[a] * self.size + vocabulary[b] for a, b in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        spelled: list[bytes] = [b""] * self.size
        for token, number in vocabulary.items():
            spelled[number] = bytes(letters[letter] for letter in token) if set(token) <= letters.keys() else token.encode()
        for token, number in specials.items():
            spelled[number] = token.encode()
        self.lengths = np.array([len(token) for token in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours, ``_NONE`` for a pair that is never merged."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and their number for each word."""
        return self.merge([word.encode("utf-8", "surrogatepass") for word in words])

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and their number for each word."""
        n = len(words)
        lengths = np.fromiter(map(len, words), np.int64, n)
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(n), lengths)
        ranks = np.full(len(symbols), _NONE, np.int32)
        inner = np.flatnonzero(word[:-1] == word[1:])
        ranks[inner] = self.ranks_of(symbols[inner], symbols[inner + 1])
        done_words, done_symbols = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.concatenate([starts, [len(symbols)]]))
            lowest = np.minimum.reduceat(ranks, starts)
            open_word = lowest != _NONE
            if not open_word.all():
                keep = np.repeat(open_word, sizes)
                done_words.append(word[~keep])
                done_symbols.append(symbols[~keep])
                symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
                sizes, lowest = sizes[open_word], lowest[open_word]
                if not len(symbols):
                    break
            hits = np.flatnonzero(ranks == np.repeat(lowest, sizes))
            # of overlapping pairs (three equal symbols) every other one is merged, from the left
            run = np.concatenate([[True], np.diff(hits) != 1])
            place = np.arange(len(hits))
            hits = hits[(place - np.maximum.accumulate(np.where(run, place, 0))) % 2 == 0]
            symbols[hits] = self.merged[ranks[hits]]
            keep = np.ones(len(symbols), bool)
            keep[hits + 1] = False
            changed = hits - np.arange(len(hits))  # where the merged symbols stand after the removal
            symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
            last = len(symbols) - 1
            ranks[changed] = _NONE
            for left in (changed[(changed < last)], changed[changed > 0] - 1):
                same = left[word[left] == word[left + 1]]
                ranks[same] = self.ranks_of(symbols[same], symbols[same + 1])
        word = np.concatenate([np.zeros(0, np.int64), *done_words])
        order = np.argsort(word, kind="stable")
        return np.concatenate([np.zeros(0, np.int64), *done_symbols])[order].astype(np.int32), np.bincount(word, minlength=n)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that are no text become replacement characters."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(lengths.sum())
        return self.bytes[places].tobytes().decode("utf-8", "replace")


class Codec:
    """Encoding and decoding with one vocabulary file."""

    def __init__(self, definition: str):
        self.rules = MergeRules(definition)
        self.table = PieceTable(lambda pieces: by_words(pieces, self.rules.merge_words), special_tokens(definition))


def codec_of(definition: str) -> Codec:
    """The codec of this worker process."""
    return table_of(definition, "rounds", Codec)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids`` (array of int) of every row."""
    definition = share_definition(docs.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(definition.value)
        for frame in frames:
            at = 0
            for batch in stretches(texts_of(frame["text"])):
                rows = frame["id"].iloc[at : at + len(batch)]
                at += len(batch)
                yield pd.DataFrame({"id": rows.to_numpy(), "ids": list(codec.table.encode_each(batch))})

    return rekeyed(keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, ids array<int>"), docs, id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``text`` of every row; null ids give the empty text."""
    definition = share_definition(encoded.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules = codec_of(definition.value).rules
        for frame in frames:
            texts = [rules.decode(np.asarray([] if ids is None else ids, np.int64)) for ids in frame["ids"]]
            yield pd.DataFrame({"id": frame["id"].to_numpy(), "text": texts})

    return rekeyed(keyed(encoded, id_col, ids=ids_col).mapInPandas(run, "id string, text string"), encoded, id_col)


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every row: ``id_col, n_tokens, ids_sha256, decoded_sha256``.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8. Both
    directions run in one pass, so neither ids nor texts leave their task.
    """
    definition = share_definition(docs.sparkSession, path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = codec_of(definition.value)
        for frame in frames:
            found = [
                (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                 hashlib.sha256(codec.rules.decode(ids).encode()).hexdigest())
                for ids in codec.table.encode_each(texts_of(frame["text"]))
            ]
            out = pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "id", frame["id"].to_numpy())
            yield out

    digests = keyed(docs, id_col, text=text_col).mapInPandas(run, "id string, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return rekeyed(digests, docs, id_col)
