"""DuckDB SQL for the operators that SQL can state; the others are tested against brute force in tests/llm."""

from __future__ import annotations

from quarry.llm import decontam, lexical, line_dedup, quality

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rn, doc_id, source, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM d),
win AS (SELECT rn, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT rn, g FROM win GROUP BY rn, g HAVING count(*) > 1),
cover AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS p FROM win JOIN twice USING (rn, g)) GROUP BY rn),
m AS (SELECT w.rn, doc_id, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
             length(t) - length(translate(t, '{quality.SYMBOLS}', '')) AS n_symbols, len(l) AS n_lines,
             len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words FROM w LEFT JOIN cover USING (rn)),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
             100 * n_symbols > {quality.SYMBOL_PERCENT} * n_words AS symbol_heavy,
             100 * n_dup_lines > {quality.DUP_LINE_PERCENT} * n_lines OR word_chars / greatest(n_words, 1) < {quality.WORD_LENGTHS[0]}
             OR word_chars / greatest(n_words, 1) > {quality.WORD_LENGTHS[1]} AS soft_failed FROM m),
h AS (SELECT source, count(*) AS n, sum(CASE WHEN base_failed OR symbol_heavy OR soft_failed THEN 1 ELSE 0 END) AS k FROM j GROUP BY source),
p AS (SELECT avg(k / n) AS m, var_pop(k / n) AS v, sum(k) / sum(n) AS c, count(*) AS hosts FROM h),
q AS (SELECT CASE WHEN hosts > 1 AND v > 0 AND v < m * (1 - m) THEN m ELSE c END AS m,
             CASE WHEN hosts > 1 AND v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE {quality.PRIOR_WEIGHT} END AS s FROM p),
r AS (SELECT source, (k + m * s) / (n + s) > {quality.HOST_LIMIT} AS host_bad FROM h, q)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT symbol_heavy AND NOT (host_bad AND soft_failed) AS kept, host_bad
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""

_WORDS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH b AS (SELECT item_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, least({decontam.WINDOW}, len(w)) AS n, array_to_string(w[i:i + least({decontam.WINDOW}, len(w)) - 1], ' ') AS g
        FROM b, unnest(range(1, len(w) - least({decontam.WINDOW}, len(w)) + 2)) AS u(i) WHERE len(w) > 0),
d AS (SELECT row_number() OVER () AS rn, doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
occ AS (SELECT rn, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM d, (SELECT DISTINCT n FROM win) AS k, unnest(range(1, len(w) - n + 2)) AS u(i)),
hit AS (SELECT rn, i, n, item_id FROM occ JOIN win USING (n, g)),
words AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + n)) AS p FROM hit) GROUP BY rn),
items AS (SELECT rn, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
          FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {decontam.HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN items USING (rn)
"""

_BLANK = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT rn, doc_id, i, l[i] AS line, {_LOWER.format(f"trim(l[i], {_BLANK})")} AS k FROM d, unnest(range(1, len(l) + 1)) AS u(i)),
s AS (SELECT k, min(doc_id) AS low FROM x WHERE length(k) >= {line_dedup.MIN_CHARS} GROUP BY k
      HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCS}),
j AS (SELECT x.*, coalesce(doc_id <> low, false) AS gone FROM x LEFT JOIN s USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY rn
"""

_TERMS = "regexp_extract_all({0}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, {_TERMS.format(_LOWER.format("coalesce(text, '')"))} AS t FROM documents),
c AS (SELECT count(*) AS n_docs, sum(len(t)) AS n_all FROM d WHERE len(t) > 0),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format(_LOWER.format("text"))}) AS term FROM benchmark),
tf AS (SELECT rn, term, count(*) AS tf FROM (SELECT rn, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rn, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, n_docs),
i AS (SELECT rn, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(t) * n_docs) // n_all))) AS v
      FROM tf JOIN d USING (rn) JOIN w USING (term), c),
s AS (SELECT item_id, rn, CAST(sum(v) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY item_id, rn),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s JOIN d USING (rn) WHERE score > 0)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM r WHERE r <= {lexical.TOP_K}
"""

SQL = {"op11_line_dedup": LINE_DEDUP, "op12_lexical_search": LEXICAL, "op6_quality": QUALITY, "op10_decontamination": DECONTAMINATION}
