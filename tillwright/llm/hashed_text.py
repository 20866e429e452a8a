"""Hashed terms of texts and bounded, labelled samples: what the two classifiers share.

A term is a word in lower case without outer punctuation, the beginning of a longer word, the shape of a
word (its kinds of characters), or a statement on the whole text (how many words and lines are repeats).
Terms are hashed to 64 bits. A model knows the ``MAX_TERMS`` terms that tell the grades of its sample apart best.
"""

from __future__ import annotations

import dataclasses
import re
from collections.abc import Callable, Iterator
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.rows import release_unused, small_batches
from tillwright.session import stored

#: Bounds of a sample and of a model: labelled texts per grade, and terms.
MAX_TEXTS, MAX_TERMS = 6_000, 8_192
#: A term occurs in so many texts of the sample, and its share in the grades differs by so much (log-likelihood ratio)
#: that chance is no explanation; others would only add noise to long texts.
MIN_TEXTS, MIN_GAIN = 3, 4.0
#: Words whose terms one worker keeps. It limits memory only.
MAX_WORDS = 300_000

_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_RUNS = ((re.compile(r"[^\W\d_]+"), lambda run: "A" if run[0].isupper() and len(run[0]) > 1 else "a"), (re.compile(r"\d+"), lambda run: "0"))


def word_terms(word: str) -> list[int]:
    """Hashes of the terms of a word as it is written."""
    core, shape = _OUTER.sub("", word.lower()), word
    for pattern, kind in _RUNS:
        shape = pattern.sub(kind, shape)
    terms = ["s " + shape[:8]]
    if core:
        terms.append("w " + core)
    terms += [f"p {core[:size]}" for size in (4, 5) if len(core) > size]
    return [xxhash.xxh3_64_intdigest(term) for term in terms]


def _level(share: float) -> int:
    return min(9, int(10 * share))


def text_terms(text: str, words: list[str]) -> list[int]:
    """Hashes of the statements on the whole text."""
    lines = text.split("\n")
    n = len(words)
    again = sum(map(eq, words, islice(words, 1, None)))
    terms = [
        f"distinct {n.bit_length()} {_level(len(set(words)) / n) if n else 'none'}",
        f"again {_level(again / n) if n else 'none'}",
        f"lines {_level(1 - len(set(lines)) / len(lines))}",
    ]
    return [xxhash.xxh3_64_intdigest(term) for term in terms]


class Terms(dict):
    """Columns of the known terms of each word; unknown terms have none."""

    def __init__(self, hashes: np.ndarray):
        super().__init__()
        self.columns = {int(one): n for n, one in enumerate(hashes)}

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > MAX_WORDS:
            self.clear()
        found = self[word] = tuple(self.columns[one] for one in word_terms(word) if one in self.columns)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Columns of the terms of a text, each once."""
        words = (text or "").split()
        found = {column for word in set(words) for column in self[word]}
        found.update(self.columns[one] for one in text_terms(text or "", words) if one in self.columns)
        return np.fromiter(found, np.int64, len(found))


@dataclasses.dataclass
class Sample:
    """Texts as columns of known terms, with grade and weight; ``hashes`` are the terms."""

    hashes: np.ndarray
    columns: np.ndarray
    starts: np.ndarray
    grades: np.ndarray
    weights: np.ndarray

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the rows one after the other, and the place of the row of each."""
        sizes = self.starts[rows + 1] - self.starts[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + self.starts[rows][owner]
        return self.columns[at], owner


def labelled_sample(docs: DataFrame, grades: DataFrame, id_col: str, text_col: str, n_grades: int, max_texts: int = MAX_TEXTS) -> Sample:
    """A bounded sample of graded texts, weighted to the grades' shares among all labels.

    ``grades`` has ``id_col`` and ``grade`` (0 to ``n_grades`` - 1). Of each grade, up to ``max_texts`` texts with
    the smallest hashes of their key are taken. Keys with several grades have the lowest.
    Of a key with several rows the greatest text counts, so that texts and weights are by key; null is lowest.
    Sample, term counts and terms are bounded by the parameters, whatever the size of the tables and however often a key occurs.
    """
    key = docs[f"`{id_col}`"].alias("id")
    ids = docs.select(key).where("id IS NOT NULL").distinct()
    labels = grades.select(grades[f"`{id_col}`"].alias("id"), "grade").where("id IS NOT NULL AND grade IS NOT NULL")
    labels = stored(labels.groupBy("id").agg(F.min("grade").alias("grade")).join(ids, "id"), "labels")
    totals = {row["grade"]: row["n"] for row in labels.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    parts = [labels.where(F.col("grade") == grade).orderBy(F.xxhash64("id"), "id").limit(max_texts) for grade in range(n_grades)]
    chosen = parts[0]
    for part in parts[1:]:
        chosen = chosen.union(part)

    def terms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_unused()
        for frame in frames:
            found = [
                np.unique(np.array([one for word in set(words) for one in word_terms(word)] + text_terms(text, words), np.uint64)).view(np.int64)
                for text in (text or "" for text in frame["text"]) for words in [text.split()]
            ]
            yield pd.DataFrame({"grade": frame["grade"], "terms": found})

    rows = docs.select(key, docs[f"`{text_col}`"].alias("text")).join(F.broadcast(chosen), "id")
    texts = rows.groupBy("id", "grade").agg(F.max("text").alias("text"))
    with small_batches(docs.sparkSession):
        sampled = stored(texts.mapInPandas(terms, "grade int, terms array<bigint>"), "sample")
    sizes = {row["grade"]: row["n"] for row in sampled.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    counts = sampled.select("grade", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("n"), *(F.sum((F.col("grade") == grade).cast("int")).alias(f"n{grade}") for grade in range(n_grades))
    )

    def surprise(part: Column, whole: Column) -> Column:
        return F.when(part > 0, part * F.log(part / whole)).otherwise(0.0)

    share = F.col("n") / F.lit(float(total or 1))
    gain = sum(
        (size * (surprise(F.col(f"n{grade}") / size, share) + surprise(1 - F.col(f"n{grade}") / size, 1 - share)) for grade, size in sizes.items()),
        F.lit(0.0),
    )
    best = counts.where(F.col("n") >= MIN_TEXTS).select("term", gain.alias("gain")).where(F.col("gain") >= MIN_GAIN).orderBy(F.col("gain").desc(), "term").limit(MAX_TERMS)
    hashes = np.array([row["term"] for row in best.collect()], np.int64)
    order = np.argsort(hashes)
    sorted_hashes = hashes[order]

    def known(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for one in frame["terms"]:
                at = np.minimum(np.searchsorted(sorted_hashes, one), max(0, len(sorted_hashes) - 1))
                found.append(order[at[sorted_hashes[at] == one]] if len(sorted_hashes) else np.zeros(0, np.int64))
            yield pd.DataFrame({"grade": frame["grade"], "columns": found, "packed": [one.astype("<u4").tobytes() for one in found]})

    # sorted, so that the fit does not depend on the order in which tasks end; as bytes, since a list has an object for each number
    known_terms = sampled.mapInPandas(known, "grade int, columns array<bigint>, packed binary").orderBy("grade", "columns")
    rows = known_terms.select("grade", "packed").collect()
    columns = [np.frombuffer(row["packed"], "<u4") for row in rows]
    found = np.array([row["grade"] for row in rows], np.int64)
    weight = {grade: totals.get(grade, 0) / size for grade, size in sizes.items()}
    weights = np.array([weight[grade] for grade in found.tolist()]) / (sum(totals.get(g, 0) for g in sizes) / total if total else 1)
    return Sample(
        hashes.view(np.uint64), np.concatenate([np.zeros(0, "<u4"), *columns]).astype(np.int64),
        np.cumsum([0, *map(len, columns)]), found, weights,
    )


def score_column(docs: DataFrame, text_col: str, hashes: np.ndarray, score: Callable[[list[np.ndarray]], dict], schema: str) -> Column:
    """A struct column of ``schema`` for the rows of ``docs``: what ``score`` returns for the term columns of many texts.

    Only the text goes to Python, so rows can be filtered by it without being joined.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hashes)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        release_unused()
        terms = Terms(shared.value)
        for batch in batches:
            parts = [score([terms.of(text) for text in batch.iloc[begin : begin + 500]]) for begin in range(0, len(batch), 500)]
            yield pd.concat([pd.DataFrame(part) for part in parts], ignore_index=True)

    return F.pandas_udf(run, schema)(docs[f"`{text_col}`"])


def sums(values: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """Sum of the rows of ``values`` at the columns of each text."""
    owner = np.repeat(np.arange(len(texts)), list(map(len, texts)))
    flat = np.concatenate([np.zeros(0, np.int64), *texts])
    found = np.zeros((len(texts), *values.shape[1:]))
    np.add.at(found, owner, values[flat])
    return found
