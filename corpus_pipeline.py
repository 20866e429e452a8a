"""The corpus pipeline: good, clean and distinct documents, freed of shared passages and packed for training.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return the columns
of ``documents``, texts of the fourth being shorter. Models are fitted on the labels of documents that are still there.

Null texts are empty to every stage. Rows count as documents of their own, also without ``doc_id`` or with one that others
have: the near-dedup keeps one row of each group and all rows that are in none. Further columns are carried along to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import near_duplicates, packing, quality, repeats, toxicity
from tillwright.llm.queries import VOCABULARY
from tillwright.session import stored

#: A text stays if it is good with this probability, and if it is toxic with less than that one.
GOOD, TOXIC = 0.5, 0.3
#: Shared windows in bytes: passages of fifty words have rarely less.
WINDOW = 224


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.quality_model(docs, quality.graded_labels(_labels(spark, sf_dir)))
    return docs.where(quality.grades_of(docs, model)["p_tail"] >= GOOD)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    model = toxicity.toxicity_model(docs, _labels(spark, sf_dir))
    return docs.where(toxicity.toxicity_of(docs, model) < TOXIC)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, the one with the smallest id (null last): five words, similarity 0.8.

    Groups are of rows, which get stored numbers for it; rows without words are in none.
    """
    number = "row"
    while number in map(str.lower, docs.columns):
        number += "_"
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates.near_duplicates(rows, id_col=number).select(number, "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", number)).alias("first")
    kept = groups.join(rows.select(number, "doc_id"), number).groupBy("component_id").agg(first).select(f"first.{number}")
    return rows.join(kept, number, "left_semi").select(*(rows[f"`{name}`"] for name in docs.columns))


def without_shared_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur in them more than once or in several; ``n_chars`` is counted anew."""
    cut = repeats.without_repeats(docs, width=WINDOW)
    counted = F.when(F.col("n_chars").isNotNull(), F.coalesce(F.length("text"), F.lit(0)).cast("bigint"))
    return cut.withColumn("n_chars", counted) if "n_chars" in docs.columns else cut


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.packed(docs, VOCABULARY)


STAGES = [
    ("quality classifier", good),
    ("toxicity", clean),
    ("MinHash near-dedup", distinct),
    ("suffix-array dedup", without_shared_passages),
    ("best-fit packing", packed),
]

#: The classifiers, the tokenizer and the packing are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, what each returns being written for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
