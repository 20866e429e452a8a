"""Quality rules against a plain version that goes word by word and sorts all values."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tillwright.llm import quality_rules

FIGURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def plain_figures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[n : n + 3]) for n in range(len(words) - 2)]
    times = Counter(windows)
    covered = {n + k for n, window in enumerate(windows) if times[window] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines)


def rounded(value):
    cut = max(value.bit_length() - 6, 0)
    return value >> cut << cut


def plain_verdicts(rows, least):
    """``rows`` of key, text, language and source; the limits straight from sorted lists."""
    found, measures, groups = [], {}, defaultdict(list)
    for place, (_, text, lang, source) in enumerate(rows):
        n_words, chars, symbols, dups, repeats, lines = plain_figures(text)
        failed = n_words < 50 or 100 * repeats > 50 * n_words
        found.append((n_words, chars, symbols, dups, repeats, failed))
        if not failed:
            measures[place] = [rounded(v) for v in (100 * chars // n_words, 1000 * symbols // n_words, 1000 * dups // lines, 1000 * repeats // n_words)]
            for group in ((lang, source), (lang,), ()):
                groups[group].append(measures[place])
    results = []
    for place, (key, _, lang, source) in enumerate(rows):
        fine = place in measures
        if fine:
            group = next(g for g in ((lang, source), (lang,), ()) if not g or len(groups[g]) >= least)
            for n, (spread, value) in enumerate(zip((50, 33, 100, 100), measures[place])):
                values = sorted(row[n] for row in groups[group])
                q1, q3 = values[-(-len(values) // 4) - 1], values[-(-3 * len(values) // 4) - 1]
                reach = 3 * max(q3 - q1, spread)
                fine &= value <= q3 + reach and (n > 0 or value >= q1 - reach)
        results.append((key, *found[place], fine))
    return sorted(results, key=repr)


def _rows(frame):
    return sorted((tuple(row) for row in frame.select("doc_id", *FIGURES, "base_failed", "kept").collect()), key=repr)


def _texts():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choices("abcdeéß", k=draw.randint(2, 9))) for _ in range(300)]

    def text(n, extra=()):
        words = draw.choices([*vocabulary, *extra], k=n)
        return "".join(word + draw.choice([" ", " ", " ", "\n", "  ", "\t"]) for word in words)

    rows = []
    for n in range(160):
        lang, source = draw.choice(["en", "de", None]), draw.choice(["a", "b", None])
        kind = draw.randrange(8)
        body = text(draw.randint(40, 200), ["###", "a|b<c>"] if kind == 0 else ["x" * 60] * 200 if kind == 1 else ["a"] * 900 if kind == 2 else ())
        if kind == 3:
            body = body + "\nsame line here\n" * draw.randint(1, 60)
        rows.append((n if n % 9 else None, body, lang, source))
    odd = [None, "", " \t\n\x0b\x0c\r", "one", "one two", "one two three", "a b c a b c", "a a a a", "x y  z\x1cq", "\nline\nline\n\n \n line\n", "\x00 | \U0001f600" * 60]
    rows += [(1000 + n, one, "en", "a") for n, one in enumerate(odd)] + [rows[1], rows[1]]
    rows.append((2000, "word " * 30_000, "en", "a"))
    rows.append((2001, " ".join(f"w{n}" for n in range(40_000)), "de", "b"))
    return rows


@pytest.mark.parametrize(("least", "parts"), [(1, 1), (20, 4), (10_000, 2)])
def test_odd_texts_against_the_plain_version(spark, least, parts):
    rows = _texts()
    docs = spark.createDataFrame([(*row, 3, "x") for row in rows], "doc_id bigint, text string, lang string, source string, n_words int, level string")
    assert _rows(quality_rules.judged(docs.repartition(parts), least=least)) == plain_verdicts(rows, least)
    if parts == 1:
        assert quality_rules.judged(docs.limit(0)).collect() == []
        named = docs.where("doc_id IS NOT NULL")
        assert quality_rules.kept(named).columns == docs.columns and 0 < quality_rules.kept(named).count() < named.count()


def test_sketches_merge_to_the_same_limits(spark):
    """Sketches of parts, added up, are the sketch of the whole."""
    rows = [(n, words, "en", f"s{n % 3}") for n, words in ((n, " ".join(f"w{k * n % 97}" for k in range(60 + n))) for n in range(60))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    measured = quality_rules._measured(quality_rules.base_figures(docs, "lang", "source"))
    whole = quality_rules.sketches(measured)
    halves = quality_rules.sketches(measured.where("n_words < 90")).union(quality_rules.sketches(measured.where("n_words >= 90")))
    added = halves.groupBy("lang", "source", "measure", "value").agg({"n": "sum"})
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, whole.collect()))


def test_plan_has_no_python(spark):
    docs = spark.createDataFrame(_texts()[:5], "doc_id bigint, text string, lang string, source string")
    for frame in (quality_rules.judged(docs), quality_rules.base_figures(docs, "doc_id")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan
