"""The two classifiers: fits, held-out accuracy, bounds of the sample, edge cases."""

import random

import numpy as np
import pandas as pd
import pytest

from tillwright.llm import hashed_text, quality, tokens, toxicity

RNG = random.Random(3)
WORDS = ["".join(RNG.choices("abcdefgh", k=6)) for _ in range(60)]


def prose(*extra):
    words = RNG.choices(WORDS, k=30) + list(extra)
    RNG.shuffle(words)
    return " ".join(words)


def sample_of(texts, grades):
    hashes = np.unique(np.array([h for text in texts for word in text.split() for h in hashed_text.word_terms(word)], np.uint64))
    terms = hashed_text.Terms(hashes)
    columns = [terms.of(text) for text in texts]
    return hashed_text.Sample(hashes, np.concatenate(columns), np.cumsum([0, *map(len, columns)]), np.array(grades), np.ones(len(grades))), terms


def test_factors_learn_a_pair():
    # the insult alone, also heaped, and the group alone are harmless
    texts = [prose("insultx", "groupx") for _ in range(150)] + [prose("insultx") for _ in range(150)] + [prose("groupx") for _ in range(150)] + [prose() for _ in range(50)]
    sample, terms = sample_of(texts, [1] * 150 + [0] * 350)
    model = toxicity.fit(sample)
    scores = model.score([terms.of(text) for text in (prose("insultx", "groupx"), prose("insultx"), prose("groupx"), prose())])
    assert scores[0] > 0.6 and scores[1:].max() < 0.4


def test_factorized_pairs_equal_all_pairs():
    rng = np.random.default_rng(2)
    model = toxicity.FactorizationMachine(np.arange(9, dtype=np.uint64), 0.3, rng.normal(size=9), rng.normal(size=(9, 4)))
    columns = np.array([0, 3, 4, 8])
    pairs = sum(model.factors[a] @ model.factors[b] for n, a in enumerate(columns) for b in columns[:n])
    plain = 1 / (1 + np.exp(-(0.3 + model.weights[columns].sum() + pairs)))
    assert np.allclose(model.score([columns, np.zeros(0, np.int64)]), [plain, 1 / (1 + np.exp(-0.3))])


def test_ordinal_grades():
    texts = [prose(*["goodx"] * 1 * (grade >= 1), *["bestx"] * (grade == 2), *["junkx"] * (grade == 0)) for grade in (0, 1, 2) * 100]
    sample, terms = sample_of(texts, (0, 1, 2) * 100)
    model = quality.fit(sample, 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails([terms.of(text) for text in (prose("junkx"), prose("goodx"), prose("goodx", "bestx"))])
    assert (tails[:, 0] >= tails[:, 1]).all()
    grades = tails.sum(axis=1)
    assert grades[0] < 0.6 < grades[1] < 1.5 < grades[2]


@pytest.fixture(scope="module")
def tables(spark):
    rows = []
    for n in range(400):
        grade = n % 4  # 0 junk, 1 toxic, 2 and 3 good
        text = " ".join(word.upper() + "!!" for word in RNG.choices(WORDS, k=30)) if grade == 0 else prose(*["nastyx"] * (grade == 1))
        rows.append((n, text, int(grade > 0), int(grade == 1)))
    docs = spark.createDataFrame([(n, text, 1, "x") for n, text, _, _ in rows], "doc_id bigint, text string, grade int, terms string").repartition(3)
    labels = spark.createDataFrame([(n, q, t, 2) for n, _, q, t in rows] + [(None, 1, 0, 2), (3, None, None, 2), (9999, 1, 1, 2)], "doc_id bigint, quality int, toxic int, grade int")
    return docs, labels


def test_held_out_documents(spark, tables):
    docs, labels = tables
    hidden = toxicity.held_out(labels["doc_id"])
    known = labels.where("doc_id < 400 AND quality IS NOT NULL")
    toxic = {row["doc_id"]: row["toxic"] for row in known.where(hidden).collect()}
    model = toxicity.toxicity_model(docs, labels.where(~hidden))
    found = {row["doc_id"]: row["score"] for row in toxicity.toxicity(docs, model).collect()}
    assert all((found[key] >= 0.3) == bool(label) for key, label in toxic.items())
    grades = {row["doc_id"]: row["quality"] for row in known.where(hidden).collect()}
    model = quality.quality_model(docs, quality.graded_labels(labels.where(~hidden)))
    found = {row["doc_id"]: row for row in quality.graded(docs, model).collect()}
    assert all((found[key]["p_tail"] >= 0.5) == bool(label) for key, label in grades.items())
    assert all(0 <= row["expected_grade"] <= 2 for row in found.values())


def test_the_sample_is_bounded(tables):
    docs, labels = tables
    sample = hashed_text.labelled_sample(docs, quality.graded_labels(labels), "doc_id", "text", 3, max_texts=20)
    assert sorted(np.bincount(sample.grades)) == [20, 20, 20]
    assert len(sample.hashes) <= hashed_text.MAX_TERMS
    assert np.allclose([sample.weights[sample.grades == grade].mean() for grade in range(3)], [0.75, 0.75, 1.5])


def test_the_fit_is_repeatable(tables):
    docs, labels = tables
    one, other = (quality.quality_model(frame, quality.graded_labels(labels)) for frame in (docs, docs.repartition(5)))
    assert (one.hashes == other.hashes).all() and np.allclose(one.weights, other.weights)


def test_rows_without_text(spark, tables):
    docs, labels = tables
    model, grades = toxicity.toxicity_model(docs, labels), quality.quality_model(docs, quality.graded_labels(labels))
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "nastyx " * 50000), (None, None)], "doc_id bigint, text string")
    scores = sorted((row["doc_id"] or 0, row["score"]) for row in toxicity.toxicity(odd, model).collect())
    assert len(scores) == 4 and scores[2][1] == scores[3][1] and scores[1][1] > 0.5
    assert quality.graded(odd, grades).count() == 4
    assert toxicity.toxicity(odd.limit(0), model).collect() == [] and quality.graded(odd.limit(0), grades).collect() == []
    assert toxicity.held_out(odd["doc_id"]) is not None


@pytest.mark.parametrize(("condition", "score"), [("false", 0.0), ("toxic = 1", 1.0), ("toxic = 0", 0.0)])
def test_labels_of_one_kind(tables, condition, score):
    docs, labels = tables
    model = toxicity.toxicity_model(docs, labels.where(condition))
    assert np.allclose([row["score"] for row in toxicity.toxicity(docs, model).collect()], score, atol=1e-9)
    assert quality.graded(docs, quality.quality_model(docs, quality.graded_labels(labels.where("false")))).count() == 400


def test_held_out_is_by_checksum(spark):
    import zlib

    keys = spark.createDataFrame([(n,) for n in [*range(50), None]], "doc_id bigint")
    found = {row[0]: row[1] for row in keys.select("doc_id", toxicity.held_out(keys["doc_id"])).collect()}
    assert found == {n: zlib.crc32(str(n).encode()) % 4 == 2 for n in range(50)} | {None: False}


def test_a_key_counts_once_in_the_sample(spark, tables):
    docs, labels = tables
    # a third of all rows bears one labelled key, with texts of its own and without
    again = spark.createDataFrame([(1, text, 1, "x") for text in [None, "", *(prose("a") for _ in range(198))]], docs.schema)
    grades = quality.graded_labels(labels)
    one, other = (hashed_text.labelled_sample(frame, grades, "doc_id", "text", 3) for frame in (docs, docs.union(again).repartition(4)))
    assert (np.bincount(other.grades) == np.bincount(one.grades)).all() and np.bincount(one.grades).tolist() == [100, 100, 200]
    assert np.allclose(other.weights, 1)
    texts = {frozenset(other.columns[a:b].tolist()) for a, b in zip(other.starts[:-1], other.starts[1:], strict=True)}
    assert frozenset() not in texts


def test_the_sample_comes_to_the_driver_as_bytes(spark, monkeypatch):
    """A list of numbers would be an object for each of them, many times the sample's size."""
    docs = spark.createDataFrame([(n, "good words here" if n % 2 else "bad words there") for n in range(60)], "doc_id bigint, text string")
    grades = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as grade")
    kind, seen = type(docs), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: seen.append(df.dtypes) or collect(df))
    sample = hashed_text.labelled_sample(docs, grades, "doc_id", "text", 2)
    assert len(sample.grades) == 60 and sample.columns.dtype == np.int64 and sample.starts[-1] == len(sample.columns) > 0
    assert sample.columns.max() < len(sample.hashes)
    assert len(seen) > 3 and not any(one.startswith("array") for types in seen for _, one in types)


def test_scores_drop_the_table_of_a_tokenizer(spark, monkeypatch):
    """A reused worker that has packed holds a table of pieces, which a classifier has no use for."""
    made, real = [], hashed_text.F.pandas_udf
    monkeypatch.setattr(hashed_text.F, "pandas_udf", lambda run, schema: made.append(run) or real(run, schema))
    docs = spark.createDataFrame([(1, "one two")], "doc_id bigint, text string")
    hashed_text.score_column(docs, "text", np.zeros(0, np.uint64), lambda texts: {"score": [0.0] * len(texts)}, "score double")
    tokens.table_of("a file", "test", lambda definition: tokens.PieceTable(None, {}))
    assert tokens._tables
    assert list(next(made[0](iter([pd.Series(["one two"])])))["score"]) == [0.0]
    assert not tokens._tables
