"""Spelling variants: words one letter apart, the frequent one of which is taken for the intended form.

Words are runs of Latin letters, A-Z in lower case. Letter-count vectors of two words one edit apart have a squared
distance of at most two (one letter more, or one letter instead of another), and products of blocks of such vectors give
all distances of a block at once. Pairs that pass, their lengths being equal or next to each other, are verified letter by letter.

Blocks must stay small whatever the vocabulary: of two words one edit apart, the letters before the middle or those
behind it are the same. So words are grouped by length and first half, and by length and second half; a group is
compared in products. A group of more than ``GROUP`` words is cut the same way again, by halves of the letters that are not yet
fixed, until one letter is free; then it has at most as many words as the alphabet allows. No pair is lost by it: whatever
half has the edit, the pair agrees on the other one. A pair found in two groups counts once.

Occurrences are counted per task before the shuffle. Null and empty texts have no words; rows count each, also repeated ones and
those without a key (its text is then empty). Very long texts and runs are taken whole. Ties go to the first form in code-point order.
Empty tables give empty results. Only the two named columns are read, so other names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.rows import keyed
from tillwright.session import stored

#: Letters a word has at least, occurrences it has at least, and how many times its own a form's occurrences are.
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: Words of a group that is not cut any more, and rows of small groups that share a product.
GROUP, BLOCK = 256, 128

#: Fixed value: the letters of words.
LETTER = "[A-Za-zÀ-ÿ]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A group: the length of its shorter words, and the letters it fixes at both ends.
_GROUP = ["base", "head", "tail"]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = None, least: int = LETTERS) -> DataFrame:
    """``word, n`` of all words of ``least`` letters or more.

    With ``every``, a run whose hash ``h`` with the key is divisible by it loses its letter number ``h % length``.
    Shorter runs are never made into rows, and tasks add up their words before the shuffle.
    """
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _UPPER.lower()), F.lit(f"{LETTER}{{{least},}}"), F.lit(0))
    found = keyed(docs, id_col, text=text_col).select("id", F.explode(runs).alias("word"))
    if every:
        h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "word").cast("binary"))
        place = (F.col("h") % F.length("word")).cast("int")
        shorter = F.concat(F.substring("word", F.lit(1), place), F.substring("word", place + 2, F.length("word")))
        found = found.withColumn("h", h).select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("word")).alias("word"))
        found = found.where(F.length("word") >= least)
    return found.groupBy("word").agg(F.count("*").alias("n"))


def _halves(words: DataFrame, base: Column, left: Column, right: Column) -> DataFrame:
    """Each word in the two groups of its length class that fix half of the free letters besides ``left`` and ``right``."""
    half = F.floor((base - left - right) / 2).cast("int")
    ends = F.array(
        F.struct((left + half).alias("left"), right.alias("right")),
        F.struct(left.alias("left"), (base - left - half).alias("right")),
    )
    cut = words.select("word", "n", base.alias("base"), F.explode(ends).alias("end"))
    return cut.select(
        "word", "n", "base",
        F.substring("word", F.lit(1), F.col("end.left")).alias("head"),
        F.when(F.col("end.right") > 0, F.substring("word", -F.col("end.right"), F.col("end.right"))).otherwise("").alias("tail"),
    )


def _first_groups(words: DataFrame) -> DataFrame:
    """Words by halves, each as one of the shorter and one of the longer words of a group."""
    base = F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("length")
    return _halves(words.select("word", "n", base), F.col("length"), F.lit(0), F.lit(0))


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``word, n, other, other_n`` of all pairs of distinct words exactly one edit apart, both ways round."""
    words = stored(words.select("word", "n"), "words")
    found, groups = [], _first_groups(words)
    while True:
        groups = stored(groups, "spelling-groups")
        sizes = groups.groupBy(*_GROUP).agg(F.count("*").alias("size")).where("size > 1")
        sized = groups.join(sizes, _GROUP)
        free = F.col("base") - F.length("head") - F.length("tail")
        final = (F.col("size") <= group) | (free <= 1)
        found.append(stored(_compared(sized.where(final).drop("size")), "near-words"))
        large = stored(sized.where(~final).drop("size"), "large-groups")
        if large.isEmpty():
            break
        groups = _halves(large.select("*", F.length("head").alias("left"), F.length("tail").alias("right")), *map(F.col, ("base", "left", "right")))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs.distinct()


def _compared(groups: DataFrame) -> DataFrame:
    """Pairs of the groups' words, blocks of neighbouring groups sharing one product."""

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if rest is not None:
                batch = pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            starts = _starts(batch)
            # the last group may go on in the next batch
            rest = batch.iloc[starts[-1] :]
            yield from _blocks(batch.iloc[: starts[-1]], starts)
        if rest is not None:
            yield from _blocks(rest, np.array([0, len(rest)]))

    dealt = groups.repartition(*_GROUP).sortWithinPartitions(*_GROUP)
    return dealt.mapInPandas(compared, "word string, n bigint, other string, other_n bigint")


def _starts(batch: pd.DataFrame) -> np.ndarray:
    """Places at which groups begin."""
    changed = np.zeros(len(batch), bool)
    changed[:1] = True
    for name in _GROUP:
        column = batch[name].to_numpy()
        changed[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(changed)


def _blocks(rows: pd.DataFrame, starts: np.ndarray) -> Iterator[pd.DataFrame]:
    """The pairs of the rows, in blocks of whole groups of ``BLOCK`` rows together or one larger group."""
    if len(rows) < 2:
        return
    bounds = [*starts[starts < len(rows)].tolist(), len(rows)]
    group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    words, n = rows["word"].to_numpy(object), rows["n"].to_numpy()
    counts = letter_counts(words.tolist())
    lengths, norms = counts.sum(axis=1), np.einsum("ij,ij->i", counts, counts)
    short = lengths == rows["base"].to_numpy()
    begin, found = 0, []
    for place in range(1, len(bounds)):
        if place + 1 == len(bounds) or bounds[place + 1] - bounds[begin] > BLOCK:
            found += _close(counts, norms, group, short, bounds[begin], bounds[place])
            begin = place
    if found:
        pairs = np.concatenate(found)
        keep = [one_edit(a, b) for a, b in zip(words[pairs[:, 0]], words[pairs[:, 1]])]
        one, other = pairs[keep].T
        here, there = np.concatenate([one, other]), np.concatenate([other, one])
        if len(here):
            yield pd.DataFrame({"word": words[here], "n": n[here], "other": words[there], "other_n": n[there]})


def _close(counts: np.ndarray, norms: np.ndarray, group: np.ndarray, short: np.ndarray, begin: int, end: int) -> list[np.ndarray]:
    """Places of pairs of rows of one group whose letter counts are close: a shorter word with another or a longer one."""
    found = []
    mine_all = begin + np.flatnonzero(short[begin:end])
    for first in range(0, len(mine_all), BLOCK):
        mine = mine_all[first : first + BLOCK]
        for start in range(begin, end, BLOCK):
            block = slice(start, min(start + BLOCK, end))
            # squared distance at most two, by the product of the two blocks
            near = 2 * (counts[mine] @ counts[block].T) >= norms[mine, None] + norms[None, block] - 2
            places, others = np.nonzero(near & (group[mine, None] == group[None, block]))
            places, others = mine[places], others + start
            found.append(np.stack([places, others], axis=1)[~short[others] | (places < others)])
    return found


def letter_counts(words: list[str]) -> np.ndarray:
    """How often each word has each letter; all letters are in Latin-1. Doubles hold the products of any word exactly."""
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    used, letters = np.unique(codes, return_inverse=True)
    rows = np.repeat(np.arange(len(words)), list(map(len, words)))
    return np.bincount(rows * len(used) + letters, minlength=len(words) * len(used)).reshape(len(words), len(used)).astype(np.float64)


def one_edit(word: str, other: str) -> bool:
    """Whether one letter inserted in ``word`` or replaced gives ``other``, which is as long or one letter longer."""
    place = 0
    for mine, its in zip(word, other):
        if mine != its:
            break
        place += 1
    return word != other and word[place + (len(word) == len(other)) :] == other[place + 1 :]


def forms(words: DataFrame, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word: near words and the most frequent one, if it is ``times`` as frequent."""
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words, group).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    taken = F.coalesce(-F.col("best.less") >= times * F.col("n"), F.lit(False))
    return words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"),
    )


def with_roots(found: DataFrame) -> DataFrame:
    """The rows of :func:`forms` with ``root``: from the word, forms followed to the last.

    Each step multiplies the occurrences, so there are as many rounds as powers of ``times`` in the table at most.
    """
    steps = stored(found.where("form IS NOT NULL").select("word", "form"), "steps")
    onward = steps.select(F.col("word").alias("root"), F.col("form").alias("next"))
    open_, closed = steps.select("word", F.col("form").alias("root")), None
    while not open_.isEmpty():
        moved = stored(open_.join(onward, "root", "left"), "roots")
        done = moved.where("next IS NULL").select("word", "root")
        closed = done if closed is None else closed.union(done)
        open_ = moved.where("next IS NOT NULL").select("word", F.col("next").alias("root"))
    if closed is None:
        return found.withColumn("root", F.col("word"))
    return found.join(closed, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int | None = None, least: int = LETTERS, occurrences: int = OCCURRENCES
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of the texts that occur often enough."""
    words = stored(word_counts(docs, id_col, text_col, every, least).where(F.col("n") >= occurrences), "word-counts")
    return with_roots(stored(forms(words), "forms")).select("word", "form", "root", "n", "n_near", "form_n")
