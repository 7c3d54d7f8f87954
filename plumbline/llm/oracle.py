"""SQL for the operators that SQL can express, in the dialect of the checking engine."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD = r"[^\x20\x09-\x0D]+"

DECONTAMINATE = rf"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS size, list_slice(w, i, i + least(10, len(w)) - 1) AS win
    FROM item_words, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
doc_words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_ITEM_WORD}'), []) AS w FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS win
    FROM doc_words, sizes, unnest(range(1, len(w) - size + 2)) AS t(i) WHERE len(w) >= size),
hits AS (SELECT doc_id, item, i, p.size FROM places p JOIN windows USING (size, win)),
found AS (
    SELECT doc_id, string_agg(DISTINCT item, ',' ORDER BY item) AS items, count(DISTINCT item) AS n
    FROM hits GROUP BY doc_id),
hit_words AS (
    SELECT doc_id, count(DISTINCT j) AS n FROM hits, unnest(range(i, i + size)) AS t(j) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(f.n, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, h.n IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN found f USING (doc_id) LEFT JOIN hit_words h USING (doc_id)"""

LLM_SQL: dict[str, str] = {"op2_decontaminate": DECONTAMINATE}

_REPEATED = f"""
    SELECT doc_id, i, len(w) AS n FROM (
        SELECT doc_id, w, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + {{size}} - 1)) AS again
        FROM words, unnest(range(1, len(w) - {{size}} + 2)) AS t(i) WHERE len(w) >= {{size}})
    WHERE again > 1"""

REPETITION = rf"""
WITH words AS (
    SELECT doc_id, text, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
lines AS (
    SELECT doc_id, sum(again - 1) AS n FROM (
        SELECT doc_id, line, count(*) AS again
        FROM documents, unnest(string_split(text, chr(10))) AS t(line)
        WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id, line)
    GROUP BY doc_id),
repeats AS ({_REPEATED.format(size=8)}),
covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM repeats, unnest(range(i, i + 8)) AS t(j) GROUP BY doc_id),
too_long AS (SELECT DISTINCT doc_id FROM ({_REPEATED.format(size=101)})),
base AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(coalesce(length(text) - length(translate(text, '#*$%&|<>', '')), 0) AS BIGINT) AS n_symbols,
        CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
        t.doc_id IS NOT NULL AS long_repeat
    FROM words LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id) LEFT JOIN too_long t USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR long_repeat) AS kept
FROM base"""

BACKOFF = rf"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS w FROM documents),
tokens AS (
    SELECT doc_id, i, w[i] AS t, CASE WHEN i > 1 THEN w[i - 1] END AS p
    FROM words, unnest(range(1, len(w) + 1)) AS u(i)),
size AS (SELECT count(*) AS n FROM tokens),
own_size AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
one AS (SELECT t, count(*) AS n FROM tokens GROUP BY t),
own_one AS (SELECT doc_id, t, count(*) AS n FROM tokens GROUP BY doc_id, t),
two AS (SELECT p, t, count(*) AS n FROM tokens WHERE p IS NOT NULL GROUP BY p, t),
own_two AS (SELECT doc_id, p, t, count(*) AS n FROM tokens WHERE p IS NOT NULL GROUP BY doc_id, p, t),
others AS (
    SELECT k.doc_id, k.p, size.n - own_size.n AS words, one.n - own_one.n AS c1,
        coalesce(two.n - own_two.n, 0) AS c2, before.n - own_before.n AS cp
    FROM tokens k JOIN size ON true JOIN own_size USING (doc_id)
    JOIN one ON one.t = k.t JOIN own_one ON own_one.doc_id = k.doc_id AND own_one.t = k.t
    LEFT JOIN one before ON before.t = k.p LEFT JOIN own_one own_before ON own_before.doc_id = k.doc_id AND own_before.t = k.p
    LEFT JOIN two ON two.p = k.p AND two.t = k.t
    LEFT JOIN own_two ON own_two.doc_id = k.doc_id AND own_two.p = k.p AND own_two.t = k.t),
valued AS (
    SELECT doc_id, p IS NOT NULL AND c2 = 0 AS backed_off,
        CASE WHEN c2 > 0 THEN c2 / cp ELSE CASE WHEN p IS NULL THEN 1 ELSE CAST(0.4 AS DOUBLE) END
            * CASE WHEN c1 > 0 THEN c1 / words ELSE CAST(0.4 AS DOUBLE) / (words + 1) END END AS s
    FROM others),
scored AS (
    SELECT doc_id, count_if(backed_off) AS b, sum(ln(s)) / count(*) AS score FROM valued GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b, 0) AS BIGINT) AS n_backed_off, round(score, 6) AS score
FROM words LEFT JOIN scored USING (doc_id)"""

BACKOFF_3 = rf"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS w FROM documents),
tokens AS (
    SELECT doc_id, i, w[i] AS t, CASE WHEN i > 1 THEN w[i - 1] END AS p, CASE WHEN i > 2 THEN w[i - 2] END AS q
    FROM words, unnest(range(1, len(w) + 1)) AS u(i)),
size AS (SELECT count(*) AS n FROM tokens),
own_size AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
own_one AS (SELECT doc_id, t, count(*) AS n FROM tokens GROUP BY doc_id, t),
own_two AS (SELECT doc_id, p, t, count(*) AS n FROM tokens WHERE p IS NOT NULL GROUP BY doc_id, p, t),
own_three AS (SELECT doc_id, q, p, t, count(*) AS n FROM tokens WHERE q IS NOT NULL GROUP BY doc_id, q, p, t),
one AS (SELECT doc_id, t, sum(n) OVER (PARTITION BY t) - n AS n FROM own_one),
two AS (SELECT doc_id, p, t, sum(n) OVER (PARTITION BY p, t) - n AS n FROM own_two),
three AS (SELECT doc_id, q, p, t, sum(n) OVER (PARTITION BY q, p, t) - n AS n FROM own_three),
others AS (
    SELECT k.doc_id, k.p, k.q, size.n - own_size.n AS words, one.n AS c1, before.n AS cp,
        coalesce(two.n, 0) AS c2, pair.n AS cqp, coalesce(three.n, 0) AS c3
    FROM tokens k JOIN size ON true JOIN own_size USING (doc_id)
    JOIN one ON one.doc_id = k.doc_id AND one.t = k.t
    LEFT JOIN one before ON before.doc_id = k.doc_id AND before.t = k.p
    LEFT JOIN two ON two.doc_id = k.doc_id AND two.p = k.p AND two.t = k.t
    LEFT JOIN two pair ON pair.doc_id = k.doc_id AND pair.p = k.q AND pair.t = k.p
    LEFT JOIN three ON three.doc_id = k.doc_id AND three.q = k.q AND three.p = k.p AND three.t = k.t),
valued AS (
    SELECT doc_id, q IS NOT NULL AND c3 = 0 AS backed_off,
        CASE WHEN c3 > 0 THEN c3 / cqp ELSE CASE WHEN q IS NULL THEN 1 ELSE CAST(0.4 AS DOUBLE) END
            * CASE WHEN c2 > 0 THEN c2 / cp ELSE CASE WHEN p IS NULL THEN 1 ELSE CAST(0.4 AS DOUBLE) END
                * CASE WHEN c1 > 0 THEN c1 / words ELSE CAST(0.4 AS DOUBLE) / (words + 1) END END END AS s
    FROM others),
scored AS (
    SELECT doc_id, count_if(backed_off) AS b, sum(ln(s)) / count(*) AS score FROM valued GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(b, 0) AS BIGINT) AS n_backed_off, round(score, 6) AS score
FROM words LEFT JOIN scored USING (doc_id)"""

LLM_SQL |= {"op5_repetition": REPETITION, "op6_backoff_scores": BACKOFF_3, "op6_backoff_scores_order2": BACKOFF}

LEXICAL = rf"""
WITH held AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w FROM documents),
docs AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM held WHERE len(w) > 0),
corpus AS (SELECT count(*) AS total, CAST(sum(n) AS BIGINT) AS length FROM docs),
items AS (
    SELECT item_id, i, regexp_extract_all({_LOWER}, '{_ITEM_WORD}') AS w
    FROM (SELECT item_id, text, row_number() OVER () AS i FROM (SELECT DISTINCT item_id, text FROM benchmark))),
item_terms AS (SELECT i, item_id, unnest(w) AS term FROM items),
item_counts AS (SELECT i, item_id, term, count(*) AS q FROM item_terms GROUP BY ALL),
doc_terms AS (
    SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM docs)
    WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
holders AS (SELECT term, count(*) AS df FROM doc_terms GROUP BY term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * total + 2) / (2 * df + 1))) AS BIGINT) AS weight FROM holders, corpus),
impacts AS (
    SELECT r, term, (1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * total) // length)) AS impact
    FROM doc_terms JOIN docs USING (r), corpus),
scores AS (
    SELECT i, item_id, r, doc_id, CAST(sum(q * weight * impact) AS BIGINT) AS score
    FROM item_counts JOIN weights USING (term) JOIN impacts USING (term) JOIN docs USING (r) GROUP BY ALL),
ranked AS (
    SELECT item_id, doc_id, score,
        row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS rank
    FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10"""

LLM_SQL["op11_lexical_search"] = LEXICAL
