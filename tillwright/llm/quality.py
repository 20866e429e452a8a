"""Quality grades by ordinal regression with cumulative links.

One weight per hashed term is shared by all grades; ordered thresholds cut the score: P(grade > k) = s(f - t_k) with
the logistic function s. The expected grade is the sum of these, the tail probability of grade g the k = g - 1 one.
The model is fitted on a bounded sample of graded texts (see ``hashed_text``), all texts are scored whole.

Null and empty texts have no words and are scored by the statements on the whole text alone. Null keys, repeated rows and other columns
don't matter. Without any label every grade is as likely as any other.
"""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.hashed_text import MAX_TEXTS, Sample, labelled_sample, score_column, sums

ROUNDS, BATCH, RATE, DECAY = 12, 64, 0.15, 1e-5


@dataclasses.dataclass
class OrdinalModel:
    """Term hashes, their weights, and the ordered thresholds between the grades."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts: list[np.ndarray]) -> np.ndarray:
        """P(grade > k) for each text and threshold k."""
        return _logistic(sums(self.weights, texts)[:, None] - self.thresholds)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(sample: Sample, n_grades: int) -> OrdinalModel:
    """Maximum likelihood by stochastic gradients with a rate of its own for each weight."""
    random = np.random.default_rng(11)
    weights = np.zeros(len(sample.hashes))
    # thresholds: the first, and the logarithms of the steps to the next, so that they stay in order
    shares = np.array([sample.weights[sample.grades > k].sum() for k in range(n_grades - 1)]) / max(sample.weights.sum(), 1e-9)
    logits = -np.log(np.clip(shares, 0.01, 0.99) / (1 - np.clip(shares, 0.01, 0.99))) if len(sample.grades) else np.linspace(-1, 1, n_grades - 1)
    place = np.concatenate([logits[:1], np.log(np.maximum(np.diff(logits), 0.1))])
    squares, place_squares = np.full(len(weights), 1e-2), np.full(len(place), 1e-1)
    for _ in range(ROUNDS):
        for rows in np.array_split(random.permutation(len(sample.grades)), max(1, len(sample.grades) // BATCH)):
            if not len(rows):
                continue
            columns, owner = sample.batch(rows)
            score = np.bincount(owner, weights[columns], len(rows))
            steps = np.exp(place[1:])
            thresholds = place[0] + np.concatenate([[0.0], np.cumsum(steps)])
            above = np.concatenate([np.ones((len(rows), 1)), _logistic(score[:, None] - thresholds), np.zeros((len(rows), 1))], axis=1)
            at, every = sample.grades[rows], np.arange(len(rows))
            upper, lower = above[every, at], above[every, at + 1]
            likelihood = np.maximum(upper - lower, 1e-9)
            slope = above * (1 - above)
            pull = sample.weights[rows] / len(rows)
            of_score = -pull * (slope[every, at] - slope[every, at + 1]) / likelihood
            gradient = np.bincount(columns, of_score[owner], len(weights)) + DECAY * weights
            squares += gradient**2
            weights -= RATE * gradient / np.sqrt(squares)
            of_threshold = np.zeros(n_grades + 1)
            np.add.at(of_threshold, at, pull * slope[every, at] / likelihood)
            np.add.at(of_threshold, at + 1, -pull * slope[every, at + 1] / likelihood)
            inner = of_threshold[1:-1]
            gradient = np.concatenate([[inner.sum()], np.cumsum(inner[::-1])[::-1][1:] * steps])
            place_squares += gradient**2
            place -= RATE * gradient / np.sqrt(place_squares)
    return OrdinalModel(sample.hashes, weights, place[0] + np.concatenate([[0.0], np.cumsum(np.exp(place[1:]))]))


def quality_model(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_grades: int = 3, max_texts: int = MAX_TEXTS) -> OrdinalModel:
    """Fit on up to ``max_texts`` texts of each grade; ``grades`` has ``id_col`` and ``grade`` from 0 to ``n_grades`` - 1."""
    return fit(labelled_sample(docs, grades, id_col, text_col, n_grades, max_texts), n_grades)


def grades_of(docs: DataFrame, model: OrdinalModel, tail: int = 1, text_col: str = "text") -> Column:
    """A struct column for ``docs``: ``expected_grade`` and ``p_tail``, which is P(grade >= ``tail``)."""

    def score(texts: list[np.ndarray]) -> dict:
        tails = model.tails(texts)
        return {"expected_grade": tails.sum(axis=1), "p_tail": tails[:, tail - 1]}

    return score_column(docs, text_col, model.hashes, score, "expected_grade double, p_tail double")


def graded(docs: DataFrame, model: OrdinalModel, tail: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, expected_grade, p_tail`` of every row."""
    return docs.select(docs[f"`{id_col}`"].alias(id_col), grades_of(docs, model, tail, text_col).alias("found")).select(id_col, "found.*")


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades from the ``labels`` table: 0 for low quality, 1 for good but toxic texts, 2 for good ones."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))
