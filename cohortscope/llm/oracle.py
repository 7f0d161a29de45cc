"""DuckDB SQL of the dealt queries, where SQL expresses them."""

from __future__ import annotations

from cohortscope.llm.decontam import UNITS

ORACLE_SQL: dict[str, str] = {
    "op4_source_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents
), sources AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][1 + (place % 3)::INT] AS weight,
         (3 * source_size)::DOUBLE AS cap
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
               row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS place
        FROM sizes GROUP BY source)
), levels AS (
  SELECT *, (total - capped) / rest AS level FROM (
    SELECT *, sum(source_size) OVER ()::DOUBLE AS total,
           sum(cap) OVER (ORDER BY cap / weight, place
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap AS capped,
           sum(weight) OVER (ORDER BY cap / weight, place
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM sources)
), targets AS (
  SELECT source, source_size, coalesce(least(cap, common * weight), cap) AS target
  FROM (SELECT *, min(CASE WHEN level <= cap / weight THEN level END) OVER () AS common FROM levels)
), budgets AS (
  SELECT *, target - copies * source_size AS rest
  FROM (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies
        FROM targets)
), placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.copies, b.rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS own
  FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       ((copies + CASE WHEN rest >= upto THEN 1 WHEN rest >= upto - own AND rest - (upto - own) >= own / 2
                       THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
""",
    "op9_exact_dedup": """
WITH normalised AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM normalised
""",
    "op3_repeated_phrases": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), phrases AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS phrase
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
), owners AS (
  SELECT phrase, min(doc_id) AS owner FROM phrases GROUP BY phrase
), gone AS (
  SELECT DISTINCT doc_id, i + d AS place
  FROM phrases JOIN owners USING (phrase), range(13) AS t(d) WHERE owner < doc_id
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS place FROM w)
  ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
""",
    "op5_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(s, '|' ORDER BY s)) AS same FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b, x.same AS a_same, y.same AS b_same
  FROM pairs JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE common / (x.n + y.n - common) >= 0.8
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
), counts AS (
  SELECT a AS doc_id, count(*) AS n_links,
         count(DISTINCT b_same) FILTER (WHERE b_same <> a_same) AS n_text_links
  FROM links GROUP BY a
)
SELECT doc_id, min(other) AS class_id, coalesce(any_value(n_links), 0) AS n_links,
       coalesce(any_value(n_text_links), 0) AS n_text_links, doc_id = min(other) AS kept
FROM reached LEFT JOIN counts USING (doc_id) GROUP BY doc_id
""",
    "op11_repeated_lines": r"""
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, line, place, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS place FROM texts)
), often AS (
  SELECT key, max(doc_id) AS owner FROM lines WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE l.doc_id <> o.owner) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE coalesce(l.doc_id = o.owner, true)), '')) AS kept_sha256
FROM lines l LEFT JOIN often o USING (key) GROUP BY l.doc_id
""",
    "op7_benchmark_templates": r"""
WITH tokens AS (
  SELECT kind, id, regexp_extract_all(regexp_replace(regexp_replace(text,
           '([0-9])[.,:]([0-9])', '\1\2', 'g'), '([0-9])[.,:]([0-9])', '\1\2', 'g'),
           '[\p{L}\p{N}]+') AS words
  FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT DISTINCT 'item', item_id, text FROM benchmark WHERE item_id IS NOT NULL)
), templates AS (
  SELECT kind, id, words, list_transform(range(1, len(words) + 1), lambda i:
           CASE WHEN ascii(words[i]) BETWEEN 48 AND 57 THEN '#number'
                WHEN lower(words[i][1]) <> words[i][1] THEN '#name'
                WHEN i > 1 AND list_contains(string_split('UNITS', ' '), words[i])
                     AND ascii(words[i - 1]) BETWEEN 48 AND 57 THEN '#unit'
                ELSE lower(words[i]) END) AS template
  FROM tokens WHERE len(words) >= 4
), items AS (
  SELECT id AS item_id, words, template, least(len(template), 8) AS size FROM templates WHERE kind = 'item'
), item_windows AS (
  SELECT item_id, i AS place, size, array_to_string(template[i + 1:i + size], ' ') AS part,
         len(list_filter(template[i + 1:i + size], lambda x: x NOT LIKE '#%')) AS literal
  FROM (SELECT *, unnest(range(0, len(template) - size + 1)) AS i FROM items)
), wanted AS (
  SELECT *, count(DISTINCT part) OVER (PARTITION BY item_id) AS n_windows
  FROM item_windows WHERE literal >= 4
), docs AS (
  SELECT id AS doc_id, words, template FROM templates WHERE kind = 'doc'
), doc_windows AS (
  SELECT doc_id, i AS place, size, array_to_string(template[i + 1:i + size], ' ') AS part
  FROM (SELECT doc_id, template, size, unnest(range(0, len(template) - size + 1)) AS i
        FROM docs, (SELECT DISTINCT size FROM wanted) WHERE len(template) >= size)
), aligned AS (
  SELECT doc_id, item_id, n_windows, d.place - w.place AS shift, count(DISTINCT part) AS n_found
  FROM doc_windows d JOIN wanted w USING (part, size) GROUP BY ALL
  HAVING count(DISTINCT part) >= 0.5 * n_windows
), slots AS (
  SELECT a.*, i.template[p] AS kind, lower(i.words[p]) AS asked, lower(d.words[p + shift]) AS given
  FROM aligned a JOIN items i USING (item_id) JOIN docs d USING (doc_id), range(1, 2000) AS r(p)
  WHERE p <= len(i.words) AND p + shift BETWEEN 1 AND len(d.words)
    AND i.template[p] LIKE '#%' AND d.template[p + shift] = i.template[p]
), mapped AS (
  SELECT doc_id, item_id, shift, kind, asked, given, count(*) AS n FROM slots GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id, shift, kind, asked
                               ORDER BY n DESC, kind, asked, given) AS to_given,
         row_number() OVER (PARTITION BY doc_id, item_id, shift, kind, given
                            ORDER BY n DESC, kind, asked, given) AS to_asked
  FROM mapped
), judged AS (
  SELECT doc_id, item_id, shift, sum(n)::BIGINT AS n_slots,
         coalesce(sum(n) FILTER (WHERE to_given = 1 AND to_asked = 1), 0)::BIGINT AS n_agree
  FROM ranked GROUP BY ALL
)
SELECT doc_id, item_id, n_windows, n_found, coalesce(n_slots, 0) AS n_slots,
       coalesce(n_agree, 0) AS n_agree
FROM aligned LEFT JOIN judged USING (doc_id, item_id, shift)
WHERE coalesce(n_agree, 0) >= 0.8 * coalesce(n_slots, 0)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_found DESC, shift) = 1
""".replace("UNITS", " ".join(UNITS)),
}
