"""Spelling variants against a plain version that compares all words with all."""

import os
import random
import re
import zlib
from collections import Counter

import pytest

from tillwright.llm import queries, spelling

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def plain_counts(rows, every):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def edits(word, alphabet):
    """All words one edit away that letters of ``alphabet`` can spell."""
    for n in range(len(word) + 1):
        yield from (word[:n] + c + word[n:] for c in alphabet)
        if n < len(word):
            yield word[:n] + word[n + 1 :]
            yield from (word[:n] + c + word[n + 1 :] for c in alphabet)


def plain_variants(rows, every=None, least=7, occurrences=2):
    counts = {word: n for word, n in plain_counts(rows, every).items() if len(word) >= least and n >= occurrences}
    alphabet = sorted(set("".join(counts)))
    found = {}
    for word, n in counts.items():
        near = {other for other in edits(word, alphabet) if other in counts} - {word}
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        found[word] = best if best and counts[best] >= 10 * n else None, len(near)

    def root(word):
        return root(found[word][0]) if found[word][0] else word

    return sorted(((word, form, root(word), counts[word], near, counts.get(form)) for word, (form, near) in found.items()), key=repr)


def _rows(frame):
    assert frame.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, frame.collect()), key=repr)


def _texts(seed, size):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcé", k=draw.randint(6, 9))) for _ in range(40)] + ["Straßenbahn", "NAÏVEté", "préférence", "a" * 60, "×÷ÿÀabcdef"]
    rows = [(n, " ".join(draw.choices(words, k=60)) + draw.choice(["", "\n1x2", " Été's"])) for n in range(size)]
    return rows + [(None, None), (None, ""), (5, "straßenbahn " * 30), (None, "Straßenbahm straßenbahm"), (7, "1234 ... !")]


@pytest.mark.parametrize("group", [2, 1024])
def test_near_words_and_forms(spark, group):
    rows = _texts(3, 60)
    counts = {word: n for word, n in plain_counts(rows, 5).items() if len(word) >= 3}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    near = {(row["word"], row["other"]) for row in spelling.near_words(words, group).collect()}
    alphabet = sorted(set("".join(counts)))
    assert near == {(word, other) for word in counts for other in edits(word, alphabet) if other in counts and other != word}
    assert near


@pytest.mark.parametrize("parts", [1, 4])
def test_variants_of_odd_texts(spark, parts):
    rows = _texts(11, 80)
    docs = spark.createDataFrame([(*row, "x") for row in rows], "doc_id bigint, text string, word string").repartition(parts)
    assert _rows(spelling.spelling_variants(docs, every=5)) == plain_variants(rows, 5)
    assert spelling.spelling_variants(docs.limit(0)).collect() == []


def test_chains_ties_and_hot_groups(spark, monkeypatch):
    """Forms of forms, ties by code point, and more words behind one beginning than a group takes."""
    counts = {"wordabcd": 1000, "wordabce": 100, "wordabfe": 10, "wordabxe": 100, "wordabzz": 10, "qwertyui": 5}
    counts |= {f"sharedbeginning{a}{b}{c}": 2 + (a + b + c).count("a") for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh"}
    rows = [(n, " ".join([word] * times)) for n, (word, times) in enumerate(counts.items())]
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    near = {(row["word"], row["other"]) for row in spelling.near_words(words, 16).collect()}
    alphabet = sorted(set("".join(counts)))
    assert near == {(word, other) for word in counts for other in edits(word, alphabet) if other in counts and other != word}
    found = _rows(spelling.spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string")))
    assert found == plain_variants(rows)
    by_word = {row[0]: row for row in found}
    assert by_word["wordabfe"][1:3] == ("wordabce", "wordabcd") and by_word["wordabcd"][1:3] == (None, "wordabcd")


def test_generated_documents_against_the_plain_version(spark):
    rows = [tuple(row) for row in queries.documents(spark, SF_DIR).select("doc_id", "text").collect()]
    assert _rows(queries.op11_spelling_variants(spark, SF_DIR)) == plain_variants(rows, 31)
