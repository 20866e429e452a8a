"""Near duplicates, repeated windows and embedding links against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tillwright.llm import components, near_duplicates, repeats, vectors

RNG = random.Random(5)
WORDS = ["".join(RNG.choices("abcdefghié", k=RNG.randint(2, 6))) for _ in range(400)]


def passage(n):
    return " ".join(RNG.choices(WORDS, k=n))


def edited(text, n):
    words = text.split(" ")
    for _ in range(n):
        words[RNG.randrange(len(words))] = RNG.choice(WORDS)
    return " ".join(words)


def merged(n, links):
    """Representative of each of n items under the links."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(x) for x in range(n)]


def answers(keys, roots, usable):
    least = {}
    for key, root, use in zip(keys, roots, usable, strict=True):
        if use:
            least[root] = min(least.get(root, key), key)
    return [least[root] if use else key for key, root, use in zip(keys, roots, usable, strict=True)]


def test_components(spark):
    links = [(a, a + 1) for a in range(40)] + [(100, n) for n in range(101, 160)] + [(7, 7), (300, 200), (200, 300), (None, 3)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint"))
    rows = {row["node"]: row["component"] for row in found.collect()}
    assert rows == {n: 0 for n in range(41)} | {n: 100 for n in range(100, 160)} | {200: 200, 300: 200}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_components_of_few_links_take_no_rounds(spark, monkeypatch):
    """A long path, whose rounds of stars would each be several shuffles: one task links it alone."""
    labels, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or stored(df, label))
    found = components.components(spark.createDataFrame([(a, a + 1) for a in range(300)], "a bigint, b bigint").repartition(8))
    assert {tuple(row) for row in found.collect()} == {(n, 0) for n in range(301)}
    assert "stars" not in labels


def test_components_over_several_tasks(spark, monkeypatch):
    labels, stored = [], components.stored
    monkeypatch.setattr(components, "stored", lambda df, label: labels.append(label) or stored(df, label))
    monkeypatch.setattr(components, "EDGES", 20)
    rng = random.Random(4)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200, n) for n in range(201, 260)]
    roots = answers(range(260), merged(260, links), [True] * 260)
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint").repartition(8))
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert sorted(map(tuple, found.collect())) == sorted((n, roots[n]) for n in nodes)
    assert "stars" in labels


def test_links_are_confirmed_in_tasks_of_many_texts(spark, monkeypatch):
    """211 shuffle partitions and a few texts: the tasks that run Python follow the texts."""
    tasks, stored = [], near_duplicates.stored

    def counted(df, label):
        if label == "links":
            tasks.append(df.rdd.getNumPartitions())
        return stored(df, label)

    monkeypatch.setattr(near_duplicates, "stored", counted)
    base = passage(100)
    frame = spark.createDataFrame([(n, edited(base, 1)) for n in range(30)], "doc_id bigint, text string")
    with_partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert near_duplicates.near_duplicates(frame).select("component_id").distinct().count() < 30
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", with_partitions)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks and max(tasks) == 1


def near_rows():
    rows = [(n, passage(RNG.choice([0, 1, 2, 3, 4, 5, 8, 20, 60, 200]))) for n in range(60)]
    base, shared = passage(150), passage(60)
    rows += [(1000 + n, edited(base, RNG.randint(0, 6))) for n in range(60)]
    for group in range(12):
        text = passage(RNG.randint(10, 120))
        rows += [(2000 + 10 * group + n, edited(text, RNG.randint(0, 3))) for n in range(5)]
    rows += [(3000 + n, f"{shared} {passage(40)}") for n in range(40)]
    return rows + [(5000, None), (5001, ""), (5002, " \n"), (None, base), (4000, base), (4000, base), (4001, base.upper()), (4002, (base + " ") * 40)]


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates(spark, words):
    rows = near_rows()
    sets = []
    for _, text in rows:
        split = (text or "").encode().lower().split()
        sets.append({tuple(split[n : n + words]) for n in range(len(split) - words + 1)} or ({tuple(split)} if split else set()))
    usable = [key is not None and bool(found) for (key, _), found in zip(rows, sets, strict=True)]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if usable[a] and usable[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    roots = answers([key for key, _ in rows], merged(len(rows), links), usable)
    expected = [(key, len(found), root, key is not None and root == key) for (key, _), found, root in zip(rows, sets, roots, strict=True)]
    frame = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, digest string, node int").repartition(4)
    assert sorted(map(tuple, near_duplicates.near_duplicates(frame, words=words).collect()), key=str) == sorted(expected, key=str)


def test_no_near_duplicates(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "one")], "doc_id bigint, text string")
    assert near_duplicates.near_duplicates(frame.limit(0)).collect() == []
    assert sorted(map(tuple, near_duplicates.near_duplicates(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True)]


def test_texts_merely_alike_are_not_compared(spark, monkeypatch):
    """A group whose texts are alike at 0.76, below the threshold: their pairs don't reach the full sets."""
    rng, counts, confirmed = random.Random(8), [], near_duplicates._confirmed
    base = [f"word{n}" for n in range(150)]
    texts = []
    for n in range(60):
        text = list(base)
        place = rng.randrange(5, 70)
        text[place], text[place + 70] = f"own{n}", f"other{n}"
        texts.append(" ".join(text))

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return confirmed(pairs, *rest)

    monkeypatch.setattr(near_duplicates, "_confirmed", counted)
    sets = [{tuple(text.split()[n : n + 5]) for n in range(146)} for text in texts]
    links = [(a, b) for a in range(60) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    expected = answers(range(60), merged(60, links), [True] * 60)
    found = near_duplicates.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    assert [row["component_id"] for row in found.orderBy("doc_id").collect()] == expected
    assert 0 < len(links) < 400 and sum(counts) < 2 * len(links) + 60


def test_bitmaps_differ_in_no_more_bits_than_sets(spark):
    rng = np.random.default_rng(3)
    for size in (1, 9, 40, 300, 3000):
        common = rng.integers(0, 1 << 63, 8 * size, np.uint64)
        one, other = (np.concatenate([common, rng.integers(0, 1 << 63, size, np.uint64)]) for _ in range(2))  # likeness of exactly 0.8
        bits = int(np.bitwise_count((near_duplicates._bitmap(one) ^ near_duplicates._bitmap(other)).view(np.uint64)).sum())
        limit = spark.range(1).selectExpr(near_duplicates._most_flipped(80, str(len(one)), str(len(other)))).first()[0]
        assert bits <= 2 * size and bits <= limit <= 2 * size


def test_signatures_are_unbiased():
    rng = np.random.default_rng(9)
    common, rest = rng.integers(0, 1 << 63, 80, np.uint64), rng.integers(0, 1 << 63, 400, np.uint64)
    shares = []
    for n in range(20):
        one, other = np.concatenate([common, rest[20 * n : 20 * n + 10]]), np.concatenate([common, rest[20 * n + 10 : 20 * n + 20]])
        first, second = near_duplicates.min_max_signatures([one, other])
        shares.append((first == second).mean())
    assert abs(np.mean(shares) - 0.8) < 0.03


def repeat_rows():
    words = WORDS[:200]

    def text(n):
        return " ".join(RNG.choices(words, k=n))

    shared, rows = [text(60) for _ in range(6)], []
    for n in range(80):
        own = text(RNG.randint(0, 80))
        for _ in range(RNG.randint(0, 3)):
            own += " " + RNG.choice(shared)[RNG.randint(0, 30) : RNG.randint(200, 400)] + " " + text(RNG.randint(0, 30))
        rows.append((n, own))
    rows += [(300 + n, edited(rows[9][1] + " " + shared[0], 2)) for n in range(30)]
    rows += [(200, "a" * 1000), (201, "ab" * 300), (202, None), (203, ""), (204, rows[5][1]), (205, rows[5][1]), (205, rows[5][1])]
    return rows + [(None, rows[7][1] + "x"), (206, "a" * 99), (207, text(20) + "a" * 150), (208, "z" * 100)]


@pytest.mark.parametrize(("width", "together"), [(100, 2000), (100, 3), (400, 2000)])
def test_repeated_windows(spark, monkeypatch, width, together):
    monkeypatch.setattr(repeats, "TOGETHER", together)
    rows = repeat_rows()
    texts = [(text or "").encode() for _, text in rows]
    windows = Counter(text[n : n + width] for text in texts for n in range(len(text) - width + 1))
    expected, kept_texts = [], []
    for (key, _), text in zip(rows, texts, strict=True):
        marks = np.zeros(len(text) + 2, bool)
        for n in range(len(text) - width + 1):
            if windows[text[n : n + width]] > 1:
                marks[n + 1 : n + 1 + width] = True
        kept = bytes(byte for byte, mark in zip(text, marks[1:], strict=False) if not mark)
        expected.append((key, len(text), int(marks.sum()), int((marks[1:] & ~marks[:-1]).sum()), hashlib.sha256(kept).hexdigest()))
        kept_texts.append((key, kept.decode("utf-8", "ignore")))
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id bigint, text string, key int, found string").repartition(4)
    found = repeats.repeat_digests(frame, width=width)
    assert sorted(map(tuple, found.drop("spans").collect()), key=str) == sorted(expected, key=str)
    if together == 3:
        cut = repeats.without_repeats(frame, width=width)
        assert cut.columns == frame.columns
        assert sorted(((row["doc_id"], row["text"] or "") for row in cut.collect()), key=str) == sorted(kept_texts, key=str)


def test_texts_longer_than_a_piece(monkeypatch, spark):
    monkeypatch.setattr(repeats, "PIECE", 256)
    text = passage(300)
    frame = spark.createDataFrame([(1, text + passage(50)), (2, passage(70) + text)], "doc_id bigint, text string")
    size = len(text.encode())
    for row in repeats.repeat_digests(frame, width=100).collect():
        assert (row["n_removed"] >= size) and (row["n_removed"] < size + 20) and row["n_spans"] == 1


def test_no_windows(spark):
    frame = spark.createDataFrame([(1, None), (2, "short")], "doc_id bigint, text string")
    assert repeats.repeat_digests(frame.limit(0)).collect() == []
    assert sorted(tuple(row)[:4] for row in repeats.repeat_digests(frame).drop("spans").collect()) == [(1, 0, 0, 0), (2, 5, 0, 0)]


def test_linked_vectors(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAF", 60)
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(1)
    points = rng.normal(size=(500, 64))
    for n in range(200):
        points[300 + n] = points[n % 30] + rng.normal(size=64) * rng.choice([0, 0.1, 0.15, 0.2, 0.25])
    rows = [(n, [float(x) for x in point.astype("f4")], (n if n < 300 else (n - 300) % 30) % 3) for n, point in enumerate(points)]
    one = rows[5][1]
    rows += [
        (1000, None, 1), (1001, [0.0] * 64, 1), (1002, [float("nan")] * 64, 1), (1003, [1.0] * 63 + [None], 1), (1004, one, None), (None, one, 2),
        (1005, [], 1), (1006, one, 2), (1006, one, 2), (1007, [1.0, 2.0], 1), (1008, [2.0, 4.0], 1), (1009, [float("inf"), 1.0], 1),
    ]
    usable = [key is not None and bool(v) and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for key, v, label in rows]
    units = [np.array(v, float) / np.linalg.norm(v) if use else None for (_, v, _), use in zip(rows, usable, strict=True)]
    links = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(units[a]) == len(units[b]) and units[a] @ units[b] >= 0.98
    ]
    degree = Counter(n for link in links for n in link)
    roots = answers([key for key, _, _ in rows], merged(len(rows), links), usable)
    expected = [(key, degree[n], roots[n], key is not None and roots[n] == key) for n, (key, _, _) in enumerate(rows)]
    frame = spark.createDataFrame([(*row, 1) for row in rows], "vec_id bigint, embedding array<float>, label int, node int").repartition(4)
    found = list(map(tuple, vectors.linked_vectors(frame).collect()))
    true, right = sum(row[1] for row in expected), sum(row[1] for row in found)
    assert 0.99 * true <= right <= true  # recall; never a link too many
    assert sum(a == b for a, b in zip(sorted(found, key=str), sorted(expected, key=str), strict=True)) >= 0.99 * len(rows)
    assert vectors.linked_vectors(frame.limit(0)).collect() == []
