"""Toxicity by a factorization machine over hashed terms.

score = s(b + sum of w_i + sum over pairs of <v_i, v_j>) over the known terms i of a text, with the logistic function s. The factors
v let a pair of terms weigh more or less than both alone. The model is fitted on a bounded
sample of labelled texts (see ``hashed_text``), all texts are scored whole; nothing but the text is an input.

Null and empty texts have no words and are scored by the statements on the whole text alone. Null keys, repeated rows and other
columns don't matter. Without any label of one kind the score is the share of the other: 0 or 1, and 0 without labels.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.hashed_text import MAX_TEXTS, Sample, labelled_sample, score_column, sums

FACTORS, ROUNDS, BATCH, RATE, DECAY, FACTOR_DECAY = 6, 12, 64, 0.1, 1e-5, 1e-3


@dataclasses.dataclass
class FactorizationMachine:
    """Term hashes, a bias, a weight and a vector of factors for each term."""

    hashes: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        every = np.concatenate([self.weights[:, None], self.factors, (self.factors**2).sum(axis=1, keepdims=True)], axis=1)
        found = sums(every, texts)
        pairs = ((found[:, 1:-1] ** 2).sum(axis=1) - found[:, -1]) / 2
        return 1 / (1 + np.exp(-np.clip(self.bias + found[:, 0] + pairs, -35, 35)))


def fit(sample: Sample) -> FactorizationMachine:
    """Weighted logistic loss by stochastic gradients with a rate of its own for each parameter."""
    random = np.random.default_rng(13)
    n = len(sample.hashes)
    weights, factors = np.zeros(n), random.normal(0, 0.01, (n, FACTORS))
    share = float(np.average(sample.grades, weights=sample.weights)) if len(sample.grades) else 0.0
    if share in (0.0, 1.0):
        return FactorizationMachine(sample.hashes, -40.0 if share == 0 else 40.0, weights, 0 * factors)
    bias, bias_square = float(np.log(share / (1 - share))), 1e-1
    squares, factor_squares = np.full(n, 1e-2), np.full((n, FACTORS), 1e-1)
    for _ in range(ROUNDS):
        for rows in np.array_split(random.permutation(len(sample.grades)), max(1, len(sample.grades) // BATCH)):
            columns, owner = sample.batch(rows)
            own = factors[columns]
            total = np.zeros((len(rows), FACTORS))
            np.add.at(total, owner, own)
            own_squares = np.bincount(owner, (own**2).sum(axis=1), len(rows))
            score = bias + np.bincount(owner, weights[columns], len(rows)) + ((total**2).sum(axis=1) - own_squares) / 2
            error = sample.weights[rows] * (1 / (1 + np.exp(-np.clip(score, -35, 35))) - sample.grades[rows]) / len(rows)
            gradient = np.bincount(columns, error[owner], n) + DECAY * weights
            squares += gradient**2
            weights -= RATE * gradient / np.sqrt(squares)
            gradient = FACTOR_DECAY * factors
            np.add.at(gradient, columns, error[owner, None] * (total[owner] - own))
            factor_squares += gradient**2
            factors = factors - RATE * gradient / np.sqrt(factor_squares)
            slope = float(error.sum())
            bias_square += slope**2
            bias -= RATE * slope / bias_square**0.5
    return FactorizationMachine(sample.hashes, bias, weights, factors)


def toxicity_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_texts: int = MAX_TEXTS) -> FactorizationMachine:
    """Fit on up to ``max_texts`` texts of each label, 0 and 1."""
    grades = labels.select(id_col, F.when(F.col(label_col).isin(0, 1), F.col(label_col)).cast("int").alias("grade"))
    return fit(labelled_sample(docs, grades, id_col, text_col, 2, max_texts))


def toxicity_of(docs: DataFrame, model: FactorizationMachine, text_col: str = "text") -> Column:
    """A column for ``docs``: the score, 0 to 1, higher for toxic texts."""
    return score_column(docs, text_col, model.hashes, lambda texts: {"score": model.score(texts)}, "score double")["score"]


def toxicity(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every row."""
    return docs.select(docs[f"`{id_col}`"].alias(id_col), toxicity_of(docs, model, text_col).alias("score"))


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the key as text leaves 2 when divided by 4; not those without a key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))
