"""Texts to token ids through a table of distinct pieces.

A byte-level BPE cuts a text by a pattern in which a space followed by something visible always
begins a new word. So a text may be cut at every such space first, and equal pieces have equal ids
wherever they stand. Each distinct piece is encoded once and its ids are copied from a table; how
a new piece is encoded is up to the caller. Texts are processed whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession

from tillwright.llm.rows import kept_by_worker

#: Entries and ids that one worker keeps. At either bound the rarer half goes and is encoded anew when met again,
#: so this limits memory only.
MAX_PIECES, MAX_IDS = 500_000, 8_000_000
#: Characters that are looked up together.
STRETCH = 1_000_000

#: The word pattern of the byte-level pre-tokenizer.
WORDS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)

#: Fixed value: the same pattern as tiktoken writes it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: What stands between pieces that are encoded in one call; pieces that hold it, or have more characters than
#: ``LONG_PIECE`` (tiktoken's pattern fails on a million blanks in a row), are encoded by the library's own model.
MARK, LONG_PIECE = "\x00\x01\x00", 10_000

_BOUNDARY = re.compile(r" (?=\S)")


class _Irregular(Exception):
    pass


class _Tails(dict):
    """Places of pieces that follow a space; the key leaves that space out."""

    def __init__(self, table: PieceTable):
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> int:
        if not piece or piece[0].isspace():
            raise _Irregular
        table = self.table
        place = self[piece] = table.n + len(table.fresh)
        table.fresh.append(" " + piece)
        return place


class PieceTable:
    """Ids of texts; ``encode_pieces`` returns the ids of many pieces and the number of ids of each."""

    def __init__(self, encode_pieces: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], specials: dict[str, int]):
        self.encode_pieces = encode_pieces
        self.specials = specials
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        self._clear()

    def _clear(self) -> None:
        self.heads: dict[str, int] = {}
        self.tails = _Tails(self)
        self.fresh: list[str] = []
        self.n = 0
        self.starts = np.zeros(1024, np.int32)
        self.lengths = np.zeros(1024, np.int32)
        self.hits = np.zeros(1024, np.int64)
        self.ids = np.zeros(4096, np.int32)
        self.used = 0
        # a special token is a piece of its own, found under a key that no text can give
        self.special_places = {}
        for text, number in self.specials.items():
            self.special_places[text] = self._store(np.array([number]), np.array([1]))

    def known(self, word: str) -> np.ndarray | None:
        """Ids of a word with its space, if it has been encoded as a piece."""
        place = self.tails.get(word[1:]) if word[0] == " " else None
        if place is None or place >= self.n:
            return None
        return self.ids[self.starts[place] : self.starts[place] + self.lengths[place]]

    def _store(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        first, n, used = self.n, self.n + len(lengths), self.used + len(ids)
        while n > len(self.starts):
            self.starts, self.lengths, self.hits = (
                np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths, self.hits)
            )
        while used > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.lengths[first:n] = lengths
        self.starts[first:n] = self.used + np.cumsum(lengths) - lengths
        self.ids[self.used : used] = ids
        self.n, self.used = n, used
        return first

    def _forget(self) -> None:
        """Keep the pieces met more than once, or start anew if they are most of the table."""
        hits, lengths, starts = self.hits[: self.n], self.lengths, self.starts
        ids, heads, tails = self.ids, self.heads, self.tails
        keep = hits > max(1, np.median(hits))
        fits = keep.sum() <= MAX_PIECES // 2 and lengths[: self.n][keep].sum() <= MAX_IDS // 2
        self._clear()
        if not fits:
            return
        for old, new in ((heads, self.heads), (tails, self.tails)):
            pieces = [(piece, place) for piece, place in old.items() if keep[place]]
            places = np.fromiter((place for _, place in pieces), np.int64, len(pieces))
            sizes = lengths[places]
            ends = np.cumsum(sizes)
            taken = ids[np.repeat(starts[places] - ends + sizes, sizes) + np.arange(sizes.sum())]
            first = self._store(taken, sizes)
            new.update((piece, first + n) for n, (piece, _) in enumerate(pieces))

    def _head(self, piece: str) -> int:
        place = self.heads.get(piece)
        if place is None:
            place = self.heads[piece] = self.n + len(self.fresh)
            self.fresh.append(piece)
        return place

    def _segment(self, text: str, places: list[int]) -> None:
        parts = text.split(" ")
        before = len(places)
        if parts[0]:
            places.append(self._head(parts[0]))
        if len(parts) == 1:
            return
        try:
            places.extend(map(self.tails.__getitem__, parts[1:]))
        except _Irregular:  # several white-space characters in a row
            del places[before:]
            head, *rest = _BOUNDARY.split(text)
            if head:
                places.append(self._head(head))
            places.extend(map(self.tails.__getitem__, rest))

    def _places(self, text: str) -> list[int]:
        places: list[int] = []
        if self.cut is None or not self.cut.search(text):
            self._segment(text, places)
        else:
            for part in self.cut.split(text):
                if part in self.special_places:
                    places.append(self.special_places[part])
                elif part:
                    self._segment(part, places)
        return places

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and the number of ids of each."""
        found = [np.array(self._places(text), np.int32) for text in texts]
        if self.fresh:
            fresh, self.fresh = self.fresh, []
            self._store(*self.encode_pieces(fresh))
        places = np.concatenate([np.zeros(0, np.int32), *found])
        lengths = self.lengths[places]
        ends = np.cumsum(lengths, dtype=np.int32)
        from_table = np.repeat(self.starts[places] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        ids = self.ids[from_table]
        totals = np.concatenate([[0], ends])
        counts = np.diff(totals[np.cumsum([0, *map(len, found)])])
        self.hits[: self.n] += np.bincount(places, minlength=self.n)
        if self.n > MAX_PIECES or self.used > MAX_IDS:
            self._forget()
        return ids, counts

    def encode_each(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, a bounded stretch of text at a time."""
        for batch in stretches(texts):
            ids, counts = self.encode(batch)
            yield from np.split(ids, np.cumsum(counts)[:-1])


def by_words(pieces: list[str], encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the pieces and their number for each, every distinct word of the pieces being encoded once."""
    numbers: dict[str, int] = {}
    cut = [  # letters behind one space are one word
        [numbers.setdefault(word, len(numbers)) for word in ([piece] if piece[1:].isalpha() and piece[0] == " " else WORDS.findall(piece))]
        for piece in pieces
    ]
    ids, lengths = encode_words(list(numbers))
    starts = np.cumsum(lengths) - lengths
    words = np.fromiter(chain.from_iterable(cut), np.int64)
    sizes = lengths[words]
    ends = np.cumsum(sizes)
    taken = ids[np.repeat(starts[words] - ends + sizes, sizes) + np.arange(sizes.sum())]
    totals = np.concatenate([[0], ends])
    return taken, np.diff(totals[np.cumsum([0, *map(len, cut)])])


def stretches(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in lists of about ``STRETCH`` characters or one longer text."""
    batch, size = [], 0
    for text in texts:
        batch.append(text)
        size += len(text) + 32
        if size >= STRETCH:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def texts_of(column: pd.Series) -> list[str]:
    """The texts of a column, the empty text for null."""
    return [text if isinstance(text, str) else "" for text in column]


def special_tokens(definition: str) -> dict[str, int]:
    """The strings that a tokenizer file takes out of a text before anything else."""
    return {token["content"]: token["id"] for token in json.loads(definition).get("added_tokens", [])}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is visible."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in visible}
    others = (byte for byte in range(256) if byte not in set(visible))
    return letters | {chr(256 + n): byte for n, byte in enumerate(others)}


def byte_ranks(definition: str) -> dict[bytes, int]:
    """Bytes and id of every ordinary token, in the order in which a byte-level BPE merges them."""
    model, letters = json.loads(definition)["model"], byte_letters()
    specials = special_tokens(definition)
    merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
    order = [model["vocab"][token] for token in merged]
    if order != sorted(order):
        raise ValueError("ids must follow the order of the merges")
    return {bytes(map(letters.__getitem__, token)): n for token, n in model["vocab"].items() if token not in specials}


def check_kind(definition: str) -> None:
    """Only byte-level BPE files that change nothing before cutting words can be used piece by piece."""
    parts = json.loads(definition)
    cutter = parts.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and not cutter.get("add_prefix_space") and cutter.get("use_regex", True)
    if parts["model"].get("type", "BPE") != "BPE" or parts.get("normalizer") or not plain:
        raise ValueError("a byte-level BPE file without a normalizer is needed")


def share_definition(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file for all tasks: it is read by the driver, a few MB by its vocabulary."""
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    check_kind(definition)
    return spark.sparkContext.broadcast(definition)


_tables: dict[tuple[str, int], PieceTable] = kept_by_worker({})


def table_of(definition: str, kind: str, build: Callable[[str], PieceTable]) -> PieceTable:
    """One table per worker process, tokenizer and way of encoding; it outlives a task, but not one of an operator that needs none."""
    key = kind, hash(definition)
    if key not in _tables:
        _tables.clear()
        _tables[key] = build(definition)
    return _tables[key]


def _by_ranks(definition: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Many pieces (none with ``MARK``) in one call of tiktoken, by the ranks of the tokenizer file."""
    import tiktoken

    ranks = byte_ranks(definition)
    mark = max(*ranks.values(), *special_tokens(definition).values(), 0) + 1
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={MARK: mark})

    def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = np.array(encoding.encode(MARK.join(pieces), allowed_special={MARK}, disallowed_special=()), np.int32)
        ends = np.append(np.flatnonzero(ids == mark), len(ids))
        return ids[ids != mark], np.diff(ends, prepend=-1) - 1

    return encode


def library_table(definition: str) -> PieceTable:
    """A table with the ids of the tokenizers library.

    New pieces are encoded by ``tiktoken`` from the bytes and ids of the same file, in a third of the library's time; the
    pieces it can't take, and files whose ids don't follow the merges, by the library's own model word by word.
    """

    def build(definition: str) -> PieceTable:
        from tokenizers import Tokenizer

        model = Tokenizer.from_str(definition).model
        letters = {byte: letter for letter, byte in byte_letters().items()}

        def spelled(word: str) -> str:
            if word.isascii() and word[1:].isalpha():
                return letters[ord(word[0])] + word[1:]
            return word.encode("utf-8", "surrogatepass").decode("latin-1").translate(letters)

        def encode_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
            found = [
                [token.id for token in model.tokenize(spelled(word))] if (ids := table.known(word)) is None else ids.tolist()
                for word in words
            ]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return np.fromiter(chain.from_iterable(found), np.int32, lengths.sum()), lengths

        def by_model(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            return by_words(pieces, encode_words)

        try:
            by_ranks = _by_ranks(definition)
        except ValueError:
            by_ranks = None

        def encode_pieces(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            if by_ranks is None:
                return by_model(pieces)
            odd = np.fromiter((len(piece) > LONG_PIECE or MARK in piece for piece in pieces), bool, len(pieces))
            if not odd.any():
                return by_ranks(pieces)
            found: list[np.ndarray] = [np.zeros(0, np.int32)] * len(pieces)
            for way, places in ((by_model, np.flatnonzero(odd)), (by_ranks, np.flatnonzero(~odd))):
                if len(places):
                    ids, counts = way([pieces[place] for place in places])
                    for place, part in zip(places, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
                        found[place] = part
            return np.concatenate(found), np.fromiter(map(len, found), np.int64, len(found))

        table = PieceTable(encode_pieces, special_tokens(definition))
        return table

    return table_of(definition, "library", build)
