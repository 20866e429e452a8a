"""Quality rules whose limits follow from the data: one set per language and source.

Base figures of a text are counted first, and texts too short or too repetitive fail whatever the rest looks like. Of the others,
four measures in whole numbers go into quantile sketches: letters per hundred words, symbols per thousand words, repeated
lines per thousand lines, repeated words per thousand words. A sketch is a table of values rounded down to six
significant bits (at most a 32nd too small) with their numbers, so merging is adding: tasks add before the shuffle, the sketches of all
sources of a language give that of the language, and those give that of the corpus. The limits are the far fences: upper quartile
plus three times the distance of the quartiles, and for the length of words the lower one as well; a distance below the
measure's least spread counts as that spread (where nearly all texts have none, the limits are then the usual fixed ones). A source and language with fewer than ``LEAST`` texts takes the limits of the language, a language with
fewer those of the corpus. The limits, one row per group, are joined to the figures; texts are read once and never shuffled.

Null and empty texts have no words: they fail. Null languages and sources are groups of their own. Rows are judged one by one, whatever
their key and how often they occur. Very long texts are counted whole. Equal values fall on the same side, since a text on the limit
stays. Empty tables give empty results. Only the named columns are read, so other names cannot clash. Windows of three words are
told apart by 64-bit hashes within their text. Everything is a DataFrame expression.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.session import stored

#: Texts of fewer words, or with more than this per cent of their words in repeated windows, fail.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Texts a group has at least for limits of its own.
LEAST = 200
#: Distances of the quartiles beyond them at which a text is too far out.
FAR = 3
#: Significant bits of the sketches' values.
BITS = 6

#: The white space that parts words, symbols, and words of a window.
BLANKS, SYMBOLS, WINDOW = " \t\n\x0b\f\r", "#*$%&|<>", 3
SPACE = "[ \\t\\n\\x0B\\f\\r]+"


@dataclass(frozen=True)
class Measure:
    """A whole number per text, its least spread between the quartiles, and whether too little of it is bad as well."""

    name: str
    value: str
    spread: int
    both_sides: bool = False


MEASURES = (
    Measure("word_length", "100 * word_chars div n_words", 50, True),
    Measure("symbols", "1000 * n_symbols div n_words", 33),
    Measure("dup_lines", "1000 * n_dup_lines div n_lines", 100),
    Measure("repeats", "1000 * n_repeat_words div n_words", 100),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more, given the hashes of all windows in order."""
    placed = F.sort_array(F.transform(hashes, lambda h, place: F.struct(h.alias("h"), place.alias("place"))))

    def starts(windows: Column) -> Column:
        def again(window: Column, n: Column) -> Column:
            beside = (F.get(windows, n - 1)["h"], F.get(windows, n + 1)["h"])
            return F.coalesce(window["h"] == beside[0], F.lit(False)) | F.coalesce(window["h"] == beside[1], F.lit(False))

        return F.sort_array(F.transform(F.filter(windows, again), lambda window: window["place"]))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))

    def step(so_far: Column, place: Column) -> Column:
        new = F.least(F.lit(WINDOW), place - so_far["last"])
        return F.struct(place.alias("last"), (so_far["total"] + new).alias("total"))

    found = F.aggregate(_let(placed, starts), start, step, lambda last: last["total"])
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(found)


def repeated_words(words: Column) -> Column:
    """Words of an array that stand in a window of three found more than once, the first one included."""
    places = F.sequence(F.lit(0), F.size(words) - WINDOW)
    hashes = F.transform(places, lambda n: F.xxhash64(*(F.get(words, n + k) for k in range(WINDOW))))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_let(hashes, _covered))


def base_figures(docs: DataFrame, *keep: str, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words`` of every row."""
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    words = F.array_remove(F.split(text, SPACE), "")
    counted = _let(words, lambda found: F.struct(F.size(found).alias("n_words"), repeated_words(found).alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    told = _let(lines, lambda found: F.struct(F.size(found).alias("n"), F.size(F.array_distinct(found)).alias("distinct")))
    length = F.length(text)
    rows = docs.select(
        *(docs[f"`{name}`"].alias(name) for name in keep), counted.alias("counted"), told.alias("lines"),
        F.length(F.translate(text, BLANKS, "")).alias("word_chars"), (length - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    figures = {
        "n_words": F.col("counted.n_words"), "word_chars": F.col("word_chars"), "n_symbols": F.col("n_symbols"), "n_lines": F.col("lines.n"),
        "n_dup_lines": F.col("lines.n") - F.col("lines.distinct"), "n_repeat_words": F.col("counted.n_repeat_words"),
    }
    return rows.select(*keep, *(value.cast("bigint").alias(name) for name, value in figures.items()))


def base_failed() -> Column:
    """Whether the figures of a text fail the fixed rules."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def rounded(value: Column) -> Column:
    """A whole number with all but its leading bits cleared."""
    cut = F.greatest(F.length(F.bin(value)) - BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, cut), cut)


def _measured(figures: DataFrame) -> DataFrame:
    """The figures with each measure, rounded, under its name."""
    return figures.withColumns({m.name: rounded(F.expr(m.value).cast("bigint")) for m in MEASURES})


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, measure, value, n``: how many texts of each language and source have each rounded value."""
    pairs = F.array(*(F.struct(F.lit(m.name).alias("measure"), F.col(m.name).alias("value")) for m in MEASURES))
    rows = measured.select("lang", "source", F.explode(pairs).alias("one")).select("lang", "source", "one.*")
    return rows.groupBy("lang", "source", "measure", "value").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame) -> DataFrame:
    """The sketches of sources (level 2), of languages (1) and of the corpus (0), those of a level being sums of the level above."""
    keys = ["level", "lang", "source", "measure", "value"]
    total = F.sum("n").alias("n")
    nothing = F.lit(None).cast("string")
    languages = sketch.groupBy("lang", "measure", "value").agg(total)
    corpus = languages.groupBy("measure", "value").agg(total)
    return (
        sketch.select(F.lit(2).alias("level"), *keys[1:], "n")
        .union(languages.select(F.lit(1), "lang", nothing, "measure", "value", "n"))
        .union(corpus.select(F.lit(0), nothing, nothing, "measure", "value", "n"))
    )


def limits(levels: DataFrame) -> DataFrame:
    """``level, lang, source, texts`` with the lowest and highest allowed value of every measure, from merged sketches.

    A quartile is the smallest value that a quarter (or three) of the texts don't exceed. A group has few distinct values, which is what
    the window goes over.
    """
    group = ["level", "lang", "source"]
    so_far = Window.partitionBy(*group, "measure").orderBy("value")
    ranked = levels.withColumn("upto", F.sum("n").over(so_far)).withColumn(
        "texts", F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    )
    quartiles = ranked.groupBy(*group, "measure").agg(
        F.max("texts").alias("texts"),
        F.min(F.when(4 * F.col("upto") >= F.col("texts"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("texts"), F.col("value"))).alias("q3"),
    )
    fences = []
    for m in MEASURES:
        here = F.col("measure") == m.name
        reach = FAR * F.greatest(F.col("q3") - F.col("q1"), F.lit(m.spread))
        fences.append(F.max(F.when(here, F.col("q3") + reach)).alias(f"{m.name}_most"))
        if m.both_sides:
            fences.append(F.max(F.when(here, F.col("q1") - reach)).alias(f"{m.name}_least"))
    return quartiles.groupBy(*group).agg(F.max("texts").alias("texts"), *fences)


def group_limits(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, source`` of every group with the limits that hold there, from :func:`sketches`."""
    every = stored(limits(merged(sketch)), "quality-limits")
    own = every.where("level = 2").select(F.col("lang").alias("own_lang"), F.col("source").alias("own_source"), F.col("texts").alias("own_texts"))
    wider = every.where("level = 1").select(F.col("lang").alias("wide_lang"), F.col("texts").alias("wide_texts"))
    sized = own.join(wider, F.col("own_lang").eqNullSafe(F.col("wide_lang")))
    level = F.when(F.col("own_texts") >= least, 2).when(F.col("wide_texts") >= least, 1).otherwise(0)
    picked = sized.select("own_lang", "own_source", level.alias("level")).select(
        "own_lang", "own_source", F.col("level").alias("own_level"),
        F.when(F.col("level") > 0, F.col("own_lang")).alias("from_lang"), F.when(F.col("level") > 1, F.col("own_source")).alias("from_source"),
    )
    same = (
        (F.col("own_level") == F.col("level")) & F.col("from_lang").eqNullSafe(F.col("lang")) & F.col("from_source").eqNullSafe(F.col("source"))
    )
    bounds = [name for name in every.columns if name.endswith(("_most", "_least"))]
    return picked.join(every, same).select(F.col("own_lang").alias("lang"), F.col("own_source").alias("source"), *bounds)


def verdict() -> Column:
    """Whether the measures of a text are within the limits joined to it."""
    fine = F.lit(True)
    for m in MEASURES:
        fine = fine & (F.col(m.name) <= F.col(f"{m.name}_most"))
        if m.both_sides:
            fine = fine & (F.col(m.name) >= F.col(f"{m.name}_least"))
    return fine


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST) -> DataFrame:
    """Per row: key, base figures, the measures, ``base_failed`` and ``kept``.

    The sketches are of the texts that pass the fixed rules: a heap of broken texts doesn't move the limits.
    """
    counted = base_figures(docs, id_col, lang_col, source_col, text_col=text_col)
    counted = counted.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{source_col}`").cast("string").alias("source"), *counted.columns[3:])
    figures = stored(counted.withColumn("base_failed", base_failed()), "quality-figures")
    passed = _measured(figures.where(~F.col("base_failed")))
    bounds = group_limits(sketches(passed), least).withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    within = passed.join(bounds, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source")))
    names = [*figures.columns, *(m.name for m in MEASURES)]
    failed = figures.where("base_failed").withColumns({m.name: F.lit(None).cast("bigint") for m in MEASURES})
    rows = within.select(*names, verdict().alias("kept")).union(failed.select(*names, F.lit(False)))
    return rows.drop("lang", "source").withColumnRenamed("id", id_col)


def kept(docs: DataFrame, id_col: str = "doc_id", **columns: str) -> DataFrame:
    """The rows that the rules keep, as they are, for tables whose ``id_col`` is unique and not null."""
    return docs.join(judged(docs, id_col, **columns).where("kept").select(id_col), id_col, "left_semi").select(*(docs[f"`{name}`"] for name in docs.columns))
