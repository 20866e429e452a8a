"""Fingerprints and list joins: plans without Python, results against plain versions."""

import datetime
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillwright.llm import fingerprints, url_lists

RNG = random.Random(8)


def plain_sketch(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashes = {hashlib.md5(" ".join(words[n : n + 5]).encode()).hexdigest()[:16] for n in range(max(len(words) - 4, 1))} if words else set()
    return sorted({one for one in hashes if one < "2"} or ({min(hashes)} if hashes else set()))


def plain_likeness(one, other):
    return len(set(one) & set(other)) / len(set(one) | set(other)) if one or other else 1.0


@pytest.mark.parametrize("partitions", ["4", "1"])
def test_edited_fingerprints(spark, partitions):
    texts = [" ".join(RNG.choices(["on", "in", "über", "the", "a😀b", "x"], k=RNG.choice([0, 1, 3, 6, 40, 300]))) for _ in range(60)]
    rows = [(3 * n, text) for n, text in enumerate(texts)] + [(500, None), (501, "same text"), (501, "same text"), (502, "  \n\t "), (None, "no key here at all"), (900, texts[4])]
    order = sorted(rows, key=lambda row: (row[0] is None, -(row[0] or 0), row[1] or ""))
    expected = []
    for n, (key, text) in enumerate(order):
        text, following = text or "", order[(n + 1) % len(order)][1] or ""
        edit = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, changed = plain_sketch(text), plain_sketch(edit)
        expected.append((key, len(text), hashlib.sha256(edit.encode()).hexdigest(), "".join(own), "".join(changed), plain_likeness(own, changed), plain_likeness(own, plain_sketch(following))))
    frame = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id bigint, text string, range int, sketch string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = fingerprints.edited_fingerprints(frame)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
        assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
        assert fingerprints.edited_fingerprints(frame.limit(0)).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_containment_and_merging(spark):
    words = [str(n) for n in range(4000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:400])), (3, " ".join(words[3000:] + ["new"] * 5))]
    found = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id bigint, text string"))
    a, b = (found.where(f"doc_id = {n}").select(F.col("sketch").alias(name)) for n, name in ((1, "one"), (2, "other")))
    pair = a.crossJoin(b).select(fingerprints.containment(F.col("other"), F.col("one")), fingerprints.likeness(F.col("one"), F.col("other"))).first()
    assert pair[0] == 1.0 and 0.05 < pair[1] < 0.16
    merged = fingerprints.merged_sketches(found.withColumn("all", F.lit(1)), "all", "sketch")
    assert {row["hash"] for row in merged.collect()} == {one for row in found.collect() for one in row["sketch"]}


def day(n):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=n)


def test_lists_as_of_the_day(spark):
    changes = [
        ("block", "domain", "bad.com", "add", day(10)), ("block", "domain", "bad.com", "remove", day(20)), ("block", "domain", "bad.com", "add", day(30)),
        ("allow", "prefix", "bad.com/good", "add", day(12)), ("block", "url", "fine.org/a/b", "add", day(0)),
        ("block", "domain", "both.com", "add", day(5)), ("block", "domain", "both.com", "remove", day(5)),
        ("block", "domain", None, "add", day(1)), ("block", "domain", "bad.com", "add", None), ("block", "domain", "com", "add", day(100)),
    ]
    captures = [
        (1, "http://bad.com/", day(9), 0, "", True), (2, "http://bad.com/", day(10), 1, "block", False), (3, "HTTPS://user@Sub.Bad.com:8080/x?q#f", day(19), 1, "block", False),
        (4, "http://bad.com/", day(20), 0, "", True), (5, "http://bad.com//good/page", day(31), 2, "allow,block", True), (6, "http://notbad.com/", day(31), 0, "", True),
        (7, "http://fine.org/a/b/", day(3), 1, "block", False), (8, "http://fine.org/a/b/c", day(3), 0, "", True), (9, "http://both.com", day(6), 0, "", True),
        (10, None, day(6), 0, "", True), (11, "no url", day(6), 0, "", True), (12, "http://bad.com/", None, 0, "", True), (None, "http://x.com/", day(200), 1, "block", False),
        (13, "http://bad.com/goodies", day(12), 1, "block", False), (13, "http://bad.com/goodies", day(12), 1, "block", False),
    ]
    frame = spark.createDataFrame([(a, b, c, 1, "x") for a, b, c, *_ in captures], "page_id bigint, url string, day date, n_entries int, list string")
    intervals = url_lists.validity_intervals(spark.createDataFrame(changes, "list string, kind string, entry string, action string, changed_on date"))
    found = url_lists.judged(frame, intervals, "page_id", "url", "day")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([(a, b, c, *rest) for a, b, c, *rest in captures], key=str)
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().executedPlan().toString())
    assert url_lists.judged(frame.limit(0), intervals, "page_id", "url", "day").collect() == []
    assert url_lists.judged(frame, intervals.limit(0), "page_id", "url", "day").where("NOT allowed").collect() == []
