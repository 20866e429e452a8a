"""Document fingerprints: a sketch that keeps every shingle hash below a fixed fraction of all hashes.

Because the threshold is the same for all texts, sketches of any sizes can be merged (union) and compared: the share of
a small text's hashes that a large one has estimates containment, the share of common ones among all
estimates likeness. A text none of whose hashes is below the threshold keeps its smallest one, so that
only texts without words have an empty sketch.

Words are what lies between ASCII white space, as written; a shingle is five words, or all of a shorter
text. Hashes are the first 16 hexadecimal digits of MD5. Null texts are empty. Two empty sketches are
alike (1), an empty and another one are not (0). Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORDS = 5
#: Hashes below this are kept: the first digit is 0 or 1, an eighth of all.
BELOW = "2"
#: The white space that parts words.
SPACE = "[ \\t\\n\\x0B\\f\\r]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """Hash of every shingle of a text, with repeats."""
    found = F.filter(F.split(text, SPACE), lambda word: word != "")
    # one hash per shingle; the words are split once, in the outer transform over a single-element array
    hashes = F.transform(
        F.array(found),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size(w) - words + 1, F.lit(1))),
                lambda n: F.substring(F.md5(F.array_join(F.slice(w, n, words), " ").cast("binary")), 1, 16),
            )
        ),
    )
    return F.element_at(hashes, 1)


def sketch(text: Column, words: int = WORDS) -> Column:
    """The kept hashes of a text, sorted."""
    kept = F.transform(
        F.array(shingle_hashes(F.coalesce(text, F.lit("")), words)),
        lambda hashes: F.when(F.array_min(hashes) >= BELOW, F.array(F.array_min(hashes))).otherwise(
            F.filter(hashes, lambda one: one < BELOW)
        ),
    )
    return F.array_sort(F.array_distinct(F.element_at(kept, 1)))


def common(one: Column, other: Column) -> Column:
    return F.size(F.array_intersect(one, other))


def likeness(one: Column, other: Column) -> Column:
    """Estimated common shingles among all shingles of two texts, 0 to 1."""
    every = F.size(one) + F.size(other) - common(one, other)
    return F.when(every == 0, 1.0).otherwise(common(one, other) / every)


def containment(one: Column, other: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has, 0 to 1; an empty text is in any."""
    below = F.filter(one, lambda value: value < BELOW)
    basis = F.when(F.size(below) > 0, below).otherwise(one)
    return F.when(F.size(basis) == 0, 1.0).otherwise(common(basis, other) / F.size(basis))


def merged_sketches(sketches: DataFrame, key: str, column: str) -> DataFrame:
    """The sketch of all texts of each ``key`` taken together, as one row per hash; partial sets are merged before the shuffle."""
    return sketches.select(key, F.explode(column).alias("hash")).distinct()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``id_col`` and ``sketch`` (array) of every row."""
    return docs.select(docs[f"`{id_col}`"].alias(id_col), sketch(docs[f"`{text_col}`"], words).alias("sketch"))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, sketch`` of every row with ``next_text, next_sketch`` of the row after it.

    Rows follow each other by descending key (nulls last), equal keys by text; the first follows the last. Keys are cut
    into ranges, and the first row of the following range stands at the end of each, so texts are moved once.
    The bounds of the ranges and one row per range are all that meets in one place.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"))
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)], 100 * n)).first()[0]
    cuts = sorted(set(cuts or []))
    smaller = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < F.col("id"))) if cuts else F.lit(0)
    ranged = rows.withColumn("range", F.coalesce(F.when(F.col("id").isNotNull(), smaller), F.lit(-1)))
    tops = ranged.groupBy("range").agg(F.max("id").alias("top"))
    before = Window.orderBy("range")
    order = tops.select(
        "range", "top", F.coalesce(F.lead("range").over(before), F.min("range").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("above")
    )
    firsts = ranged.join(F.broadcast(order), "range").where(F.col("id").eqNullSafe(F.col("top"))).groupBy("above").agg(F.min("text").alias("text"))
    heads = firsts.select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "text", F.col("above").alias("range"), F.lit(True).alias("head"))
    every = ranged.withColumn("head", F.lit(False)).unionByName(heads).withColumn("sketch", sketch(F.col("text")))
    following = Window.partitionBy("range").orderBy("head", F.col("id").desc_nulls_last(), "text")
    return (
        every.withColumn("next_text", F.lead("text").over(following))
        .withColumn("next_sketch", F.lead("sketch").over(following))
        .where("NOT head")
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edits: the last half replaced by the beginning of the next text.

    ``id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = with_next(docs, id_col, text_col).withColumn("edited", edited)
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited")))
    return rows.select(
        F.col("id").alias(id_col),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.array_join("sketch", "").alias("fingerprint"),
        F.array_join("edited_sketch", "").alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
