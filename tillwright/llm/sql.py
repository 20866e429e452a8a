"""SQL for DuckDB of the registered queries that SQL can express."""

from __future__ import annotations

# fixed values: words and their shingles are those that the queries promise
_WORDS = r"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
_PLAIN_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
sets AS (
  SELECT row, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[n:n + 3], ' ') for n in range(1, len(w) - 2)]) END AS shingles
  FROM worded
),
classes AS (SELECT min(doc_id) AS node, list_sort(shingles) AS shingles, len(shingles) AS n FROM sets WHERE len(shingles) > 0 GROUP BY ALL),
flat AS (SELECT node, n, unnest(shingles) AS shingle FROM classes),
links AS (
  SELECT a.node AS a, b.node AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.node < b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, seen) AS (SELECT node, node FROM classes UNION SELECT reach.node, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.seen),
named AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT sets.doc_id, CAST(len(sets.shingles) AS BIGINT) AS n_shingles, coalesce(named.component_id, sets.doc_id) AS component_id,
  sets.doc_id = coalesce(named.component_id, sets.doc_id) AS kept
FROM sets LEFT JOIN classes ON list_sort(sets.shingles) = classes.shingles LEFT JOIN named ON named.node = classes.node
"""

REPEATS = """
WITH bytes AS (SELECT row_number() OVER () AS row, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
sized AS (SELECT *, CAST(len(h) // 2 AS BIGINT) AS n FROM bytes),
starts AS (SELECT row, unnest(range(0, n - 399)) AS p, h FROM sized WHERE n >= 400),
windows AS (SELECT row, p, md5(h[2 * p + 1:2 * p + 800]) AS w FROM starts),
repeated AS (SELECT row, p FROM windows WHERE w IN (SELECT w FROM windows GROUP BY w HAVING count(*) > 1)),
marked AS (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY row ORDER BY p) + 400 THEN 0 ELSE 1 END AS opens FROM repeated),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY row ORDER BY p) AS span FROM marked),
spans AS (SELECT row, span, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY row, span),
gaps AS (
  SELECT row, a, b, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a) AS before, lead(a) OVER (PARTITION BY row ORDER BY a) AS after FROM spans
),
cut AS (
  SELECT s.row, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(s.h[2 * before + 1:2 * a] || CASE WHEN after IS NULL THEN s.h[2 * b + 1:] ELSE '' END, '' ORDER BY a) AS kept
  FROM gaps JOIN sized s USING (row) GROUP BY s.row
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM sized LEFT JOIN cut USING (row)
"""


def _sketch(hashes: str) -> str:
    return (
        f"CASE WHEN len({hashes}) = 0 THEN [] WHEN list_min({hashes}) >= '2' THEN [list_min({hashes})]"
        f" ELSE list_sort(list_distinct([one for one in {hashes} if one < '2'])) END"
    )


def _hashes(words: str) -> str:
    return (
        f"CASE WHEN len({words}) = 0 THEN [] ELSE [left(md5(array_to_string({words}[n:n + 4], ' ')), 16)"
        f" for n in range(1, greatest(len({words}) - 4, 1) + 1)] END"
    )


def _likeness(one: str, other: str) -> str:
    every = f"(len({one}) + len({other}) - len(list_intersect({one}, {other})))"
    return f"CASE WHEN {every} = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({one}, {other})) / {every} END"


FINGERPRINTS = f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n FROM documents),
following AS (
  SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER (ORDER BY doc_id DESC NULLS LAST, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS next_text
  FROM texts WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text)
),
edits AS (SELECT *, left(text, n - n // 2) || left(next_text, n // 2) AS edited FROM following),
words AS (
  SELECT doc_id, n, edited, {_PLAIN_WORDS.format(text="text")} AS w, {_PLAIN_WORDS.format(text="edited")} AS we, {_PLAIN_WORDS.format(text="next_text")} AS wn
  FROM edits
),
hashed AS (SELECT doc_id, n, edited, {_hashes("w")} AS h, {_hashes("we")} AS he, {_hashes("wn")} AS hn FROM words),
sketched AS (SELECT doc_id, n, edited, {_sketch("h")} AS s, {_sketch("he")} AS se, {_sketch("hn")} AS sn FROM hashed)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, coalesce(array_to_string(s, ''), '') AS fingerprint,
  coalesce(array_to_string(se, ''), '') AS edited_fingerprint, {_likeness("s", "se")} AS near_edited, {_likeness("s", "sn")} AS near_next
FROM sketched
"""

# the derived lists of queries.url_changes, then intervals and look-up
URL_LISTS = r"""
WITH captures AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched_on,
    lower(regexp_replace(regexp_replace(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')) AS host,
    [part for part in string_split(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') if part <> ''] AS parts
  FROM pages
),
addressed AS (SELECT *, array_to_string(list_concat([host], parts), '/') AS address, string_split(host, '.') AS labels FROM captures WHERE host <> ''),
named AS (
  SELECT DISTINCT 'block' AS list, 'domain' AS kind, host AS entry FROM addressed
  UNION ALL SELECT DISTINCT 'allow', 'prefix', host || '/' || parts[1] FROM addressed WHERE len(parts) > 0
  UNION ALL SELECT DISTINCT 'block', 'url', address FROM addressed
),
digits AS (
  SELECT *, [CAST(instr('0123456789abcdef', substr(md5(entry), n, 1)) - 1 AS INTEGER) for n in [1, 2, 3, 4]] AS d FROM named
),
listed AS (SELECT * FROM digits WHERE d[1] < CASE kind WHEN 'domain' THEN 6 WHEN 'prefix' THEN 4 ELSE 1 END),
changes AS (
  SELECT list, kind, entry, 'add' AS action, DATE '2024-01-01' + 20 * d[2] AS changed_on FROM listed
  UNION ALL SELECT list, kind, entry, 'remove', DATE '2024-01-01' + (20 * d[2] + 15 * d[3]) FROM listed
  UNION ALL SELECT list, kind, entry, 'add', DATE '2024-01-01' + (20 * d[2] + 15 * d[3] + 60) FROM listed WHERE d[4] < 8
),
days AS (SELECT list, kind, entry, changed_on, max(action) AS action FROM changes GROUP BY ALL),
periods AS (SELECT *, lead(changed_on) OVER (PARTITION BY list, kind, entry ORDER BY changed_on) AS valid_to FROM days),
keys AS (
  SELECT page_id, fetched_on, 'domain' AS kind, unnest([array_to_string(labels[n:], '.') for n in range(1, len(labels) + 1)]) AS entry FROM addressed
  UNION ALL SELECT page_id, fetched_on, 'prefix', unnest([host || '/' || array_to_string(parts[1:n], '/') for n in range(1, len(parts) + 1)]) FROM addressed
  UNION ALL SELECT page_id, fetched_on, 'url', address FROM addressed
),
matches AS (
  SELECT keys.page_id, periods.list FROM keys JOIN periods ON periods.kind = keys.kind AND periods.entry = keys.entry
  WHERE action = 'add' AND changed_on <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to)
),
per_page AS (SELECT page_id, count(*) AS n, list_sort(list_distinct(list(list))) AS lists FROM matches GROUP BY page_id)
SELECT captures.page_id, url, fetched_on, coalesce(n, 0) AS n_entries, coalesce(array_to_string(lists, ','), '') AS lists,
  coalesce(list_contains(lists, 'allow') OR NOT list_contains(lists, 'block'), true) AS allowed
FROM captures LEFT JOIN per_page USING (page_id)
"""

VECTORS = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
reach(node, seen) AS (SELECT vec_id, vec_id FROM usable UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(counted.n, 0) AS n_links, coalesce(least.component_id, e.vec_id) AS component_id,
  e.vec_id = coalesce(least.component_id, e.vec_id) AS kept
FROM embeddings e LEFT JOIN least ON least.node = e.vec_id LEFT JOIN counted ON counted.a = e.vec_id
"""

# Rows are told apart by a number of their own; a measure's value is rounded to its six leading bits.
QUALITY_RULES = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), cut AS (
    SELECT r, doc_id, lang, source, t,
        list_filter(regexp_split_to_array(t, '[ \t\n\x0B\f\r]+'), lambda w : w <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda l : regexp_matches(l, '[^ \t\n\x0B\f\r]')) AS lines
    FROM texts
), windows AS (
    SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM cut WHERE len(words) > 2)
), again AS (
    SELECT r, count(DISTINCT i + k) AS n
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS times FROM windows), unnest([0, 1, 2]) AS more(k)
    WHERE times > 1 GROUP BY r
), figures AS (
    SELECT r, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
    FROM cut LEFT JOIN again USING (r)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
), measured AS (
    SELECT r, lang, source, measure, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS v
    FROM (
        SELECT r, lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS measure,
            unnest([100 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words]) AS v
        FROM judged WHERE NOT base_failed
    )
), levels AS (
    SELECT 2 AS level, lang, source, measure, v, count(*) AS n FROM measured GROUP BY ALL
    UNION ALL SELECT 1, lang, NULL, measure, v, count(*) FROM measured GROUP BY ALL
    UNION ALL SELECT 0, NULL, NULL, measure, v, count(*) FROM measured GROUP BY ALL
), ranked AS (
    SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY v) AS upto,
        sum(n) OVER (PARTITION BY level, lang, source, measure) AS texts
    FROM levels
), quartiles AS (
    SELECT level, lang, source, measure, max(texts) AS texts, min(v) FILTER (4 * upto >= texts) AS q1, min(v) FILTER (4 * upto >= 3 * texts) AS q3
    FROM ranked GROUP BY level, lang, source, measure
), spreads(measure, spread) AS (
    VALUES ('word_length', 50), ('symbols', 33), ('dup_lines', 100), ('repeats', 100)
), fences AS (
    SELECT level, lang, source, measure, texts, q3 + 3 * greatest(q3 - q1, spread) AS most,
        CASE measure WHEN 'word_length' THEN q1 - 3 * greatest(q3 - q1, spread) END AS least
    FROM quartiles JOIN spreads USING (measure)
), picked AS (
    SELECT own.lang, own.source, own.measure,
        CASE WHEN own.texts >= 200 THEN own.most WHEN wide.texts >= 200 THEN wide.most ELSE whole.most END AS most,
        CASE WHEN own.texts >= 200 THEN own.least WHEN wide.texts >= 200 THEN wide.least ELSE whole.least END AS least
    FROM fences AS own
    JOIN fences AS wide ON wide.level = 1 AND wide.measure = own.measure AND wide.lang IS NOT DISTINCT FROM own.lang
    JOIN fences AS whole ON whole.level = 0 AND whole.measure = own.measure
    WHERE own.level = 2
), verdicts AS (
    SELECT r, bool_and(v <= most AND v >= coalesce(least, v)) AS fine
    FROM measured AS m JOIN picked AS p ON m.measure = p.measure AND m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source
    GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(fine, false) AS kept
FROM judged LEFT JOIN verdicts USING (r)
"""
