"""The registered queries and the pipeline on the generated tables."""

import os
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillwright.llm import near_duplicates, queries, repeats
from tillwright.llm.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "double": "DOUBLE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no generated tables")


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", ORACLE)
def test_sql(spark, name):
    duck = duckdb.connect()
    for file in sorted(os.listdir(SF_DIR)):
        duck.execute(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    ours, theirs = QUERIES[name](spark, SF_DIR), duck.sql(ORACLE[name])
    assert sorted((column, TYPES[kind]) for column, kind in ours.dtypes) == sorted(zip(theirs.columns, map(str, theirs.types), strict=True))
    rows, expected = [tuple(row) for row in ours.select(*theirs.columns).collect()], theirs.fetchall()
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


@pytest.fixture(scope="module")
def encoded(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = queries.documents(spark, SF_DIR).select("doc_id", "text").orderBy("doc_id").collect()
    return {row["doc_id"]: [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0] for row in rows}


def test_token_files(spark, encoded):
    sizes = np.array(list(map(len, encoded.values())))
    expected = [(key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for (key, ids), start in zip(encoded.items(), np.cumsum(sizes) - sizes, strict=True)]
    assert sorted(map(tuple, QUERIES["op6_token_files"](spark, SF_DIR).collect())) == expected


def test_packing(spark, encoded):
    rows = QUERIES["op4_packing"](spark, SF_DIR).collect()
    total = sum(map(len, encoded.values()))
    assert sum(row["length"] for row in rows) == total
    assert len({row["sequence_id"] for row in rows}) <= -(-total // 2048) + 1
    for row in rows:
        assert row["ids_crc32"] == zlib.crc32(np.array(encoded[row["doc_id"]][row["start"] : row["start"] + row["length"]], "<u4").tobytes())


def test_classifiers(spark):
    labels = {row["doc_id"]: row for row in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    grades = QUERIES["op5_quality_grades"](spark, SF_DIR).collect()
    right = [row["kept"] == bool(labels[row["doc_id"]]["quality"]) for row in grades if row["doc_id"] in labels]
    assert np.mean(right) > 0.8
    scores = QUERIES["op10_toxicity"](spark, SF_DIR).collect()
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in scores)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.3) for row in scores)
    assert len(grades) == len(scores) == queries.documents(spark, SF_DIR).count()


def test_pipeline(spark, tmp_path):
    docs, columns, stages = queries.documents(spark, SF_DIR), None, {}
    columns = docs.columns
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{n}")
        stages[name] = before, docs = docs, spark.read.parquet(f"{tmp_path}/{n}")
        if n < 4:
            assert docs.columns == columns and docs.dtypes == before.dtypes
    ids = [{row["doc_id"] for row in pair[0].select("doc_id").collect()} for pair in stages.values()]
    assert ids[0] > ids[1] > ids[2] > ids[3] == ids[4]
    before, after = stages["MinHash near-dedup"]
    assert {row["doc_id"] for row in after.collect()} == {row["doc_id"] for row in near_duplicates.near_duplicates(before).where("kept").collect()}
    before, after = stages["suffix-array dedup"]
    cut = {row["doc_id"]: row["n_bytes"] - row["n_removed"] for row in repeats.repeat_digests(before, width=corpus_pipeline.WINDOW).collect()}
    assert all(0 <= cut[row["doc_id"]] - len(row["text"].encode()) <= 6 * len(row["text"]) and row["n_chars"] == len(row["text"]) for row in after.collect())
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = sum(len(tokenizer.encode(row["text"], add_special_tokens=False).ids) + 1 for row in after.collect())
    assert sum(row["length"] for row in stages["best-fit packing"][1].collect()) == expected


def test_pipeline_takes_odd_rows(spark):
    odd = spark.createDataFrame([(1, None, None, "x"), (2, "", 0, "x"), (2, "", 0, "x"), (None, "one two three", 13, "x")], "doc_id bigint, text string, n_chars bigint, sketch string")
    for rows in (odd, odd.limit(0)):
        docs = rows
        for _, stage in corpus_pipeline.STAGES[2:]:
            docs = stage(spark, docs, SF_DIR)
        packed = docs.collect()
        assert {row["doc_id"] for row in packed} <= {1, 2, None}
        # the row without an id stays, and its text with it
        assert [row["length"] > 1 for row in packed if row["doc_id"] is None] == [True] * (rows is odd)
    for _, stage in corpus_pipeline.STAGES[:2]:
        assert stage(spark, odd, SF_DIR).columns == odd.columns
        assert stage(spark, odd.limit(0), SF_DIR).collect() == []


def test_pipeline_keeps_rows_without_or_with_a_reused_id(spark):
    def words(name):
        return " ".join(f"{name}{n}" for n in range(40))

    rows = [
        (None, words("a"), "unique"), (None, words("b"), "unique"), (7, words("c"), "unique"), (7, words("d"), "copy"), (3, words("d") + " end", "first"),
        (None, words("e"), "copy"), (9, words("e"), "first"), (None, words("f"), "one"), (None, words("f"), "one"), (8, None, "empty"), (8, "", "empty"),
    ]
    for parts in (1, 5):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, row string").repartition(parts)
        found = corpus_pipeline.distinct(spark, docs, SF_DIR)
        assert found.columns == docs.columns
        expected = [rows[n] for n in (0, 1, 2, 4, 6, 7, 9, 10)]
        assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
