"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import alignment, bpe, fingerprints, near_duplicates, packing, quality, quality_rules, repeats, spelling, sql, token_files, toxicity, url_lists, vectors
from tillwright.session import scratch_path

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose four-word shingles agree to 80 per cent."""
    return near_duplicates.near_duplicates(documents(spark, sf_dir), words=4, percent=80)


def url_changes(captures: DataFrame) -> DataFrame:
    """Dated changes of two lists made from the captured urls: hosts, first path segments and whole addresses.

    Digits of an entry's hash decide whether it is listed and when it is added, removed and added again.
    """
    url = F.col("url")
    found = captures.select(url_lists.host(url).alias("host"), url_lists.segments(url).alias("parts"), url_lists.address(url).alias("address")).where("host <> ''")
    named = (
        found.selectExpr("'block' AS list", "'domain' AS kind", "host AS entry", "6 AS below").distinct()
        .union(found.where("size(parts) > 0").selectExpr("'allow'", "'prefix'", "concat(host, '/', parts[0])", "4").distinct())
        .union(found.selectExpr("'block'", "'url'", "address", "1").distinct())
    )
    digits = [F.instr(F.lit("0123456789abcdef"), F.substring(F.md5(F.col("entry").cast("binary")), n, 1)) - 1 for n in (1, 2, 3, 4)]
    listed = named.select("list", "kind", "entry", "below", *(digit.alias(f"d{n}") for n, digit in enumerate(digits, 1))).where("d1 < below")

    def change(action: str, days: str, rows: DataFrame) -> DataFrame:
        return rows.select("list", "kind", "entry", F.lit(action).alias("action"), F.expr(f"date_add(DATE'2024-01-01', {days})").alias("changed_on"))

    return (
        change("add", "20 * d2", listed)
        .union(change("remove", "20 * d2 + 15 * d3", listed))
        .union(change("add", "20 * d2 + 15 * d3 + 60", listed.where("d4 < 8")))
    )


def op2_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list entries active on the day it was fetched, which its id decides."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    captures = pages.select("page_id", "url", F.expr("date_add(DATE'2024-01-01', CAST(page_id % 366 AS INT))").alias("fetched_on"))
    intervals = url_lists.validity_intervals(url_changes(captures))
    return url_lists.judged(captures, intervals, "page_id", "url", "fetched_on")


def op3_repeated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes covered by 400-byte strings that occur more than once, removed."""
    return repeats.repeat_digests(documents(spark, sf_dir)).drop("spans")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.packed(documents(spark, sf_dir), VOCABULARY)


def op5_quality_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document, and whether it is more likely good than not."""
    docs = documents(spark, sf_dir)
    model = quality.quality_model(docs, quality.graded_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return quality.graded(docs, model).withColumn("kept", F.col("p_tail") >= 0.5)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in Huffman-coded files and read back."""
    folder = scratch_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), VOCABULARY, folder)
    return token_files.digests(spark, folder)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all texts, of their edits and of the texts that follow."""
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded in merge rounds and decoded again."""
    return bpe.round_trip_digests(documents(spark, sf_dir), VOCABULARY)


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of one label whose cosine is 0.98 or more."""
    return vectors.linked_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.98)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from labels of documents that are not held out."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~toxicity.held_out(F.col("doc_id")))
    scores = toxicity.toxicity(docs, toxicity.toxicity_model(docs, labels))
    return scores.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, one run in thirty-one short of a letter, with the frequent words one letter away."""
    return spelling.spelling_variants(documents(spark, sf_dir), every=31)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups in which the ids of two tokenizers cover the same bytes, and how many documents hold each linked pair."""
    return alignment.alignment_digests(documents(spark, sf_dir), VOCABULARY, PIECES)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by fixed rules, then by limits of its language and source."""
    figures = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_rules.judged(documents(spark, sf_dir)).select("doc_id", *figures, "base_failed", "kept")


QUERIES = {
    query.__name__: query
    for query in (
        op1_minhash_near_duplicates, op2_url_lists, op3_repeated_windows, op4_packing, op5_quality_grades, op6_token_files,
        op7_fingerprints, op8_bpe_round_trip, op9_embedding_links, op10_toxicity, op11_spelling_variants, op12_tokenizer_alignment, op13_quality_rules,
    )
}

ORACLE = {
    "op1_minhash_near_duplicates": sql.NEAR_DUPLICATES,
    "op2_url_lists": sql.URL_LISTS,
    "op3_repeated_windows": sql.REPEATS,
    "op7_fingerprints": sql.FINGERPRINTS,
    "op9_embedding_links": sql.VECTORS,
    "op13_quality_rules": sql.QUALITY_RULES,
}
