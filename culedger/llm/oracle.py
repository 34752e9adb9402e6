"""DuckDB SQL for the queries that SQL can express, over whole tables. Written
on its own: rules and constants are stated here again."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP1 = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
         CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)] AS weight
  FROM docs GROUP BY source),
ranked AS (
  SELECT *, 3.0 * source_size / weight AS full_at,
         sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER w, 0) AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS open
  FROM sources WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT coalesce(max(CAST(total - capped AS DOUBLE) / open) FILTER (CAST(total - capped AS DOUBLE) / open <= full_at), 1e300) AS share
  FROM ranked WHERE open > 0),
goals AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), share * weight) AS target FROM sources, level),
placed AS (
  SELECT d.doc_id, d.size, CAST(g.source_size AS BIGINT) AS source_size, g.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         CASE WHEN g.source_size > 0 THEN CAST(floor(g.target) AS BIGINT) // CAST(g.source_size AS BIGINT) ELSE 0 END AS epochs
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - epochs * source_size - start)) AS BIGINT) AS taken
FROM placed
"""

OP2 = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i : i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l ON l.a = d.doc_id
"""

OP3 = r"""
WITH RECURSIVE own AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<!doctype[^>]*>', '', 'g'),
           '[\r\n]+', ' ', 'g'),
           '(?i)<(?:/?(?:p|div|h[1-6]|li|ul|ol|article|nav|footer|header|section|table|tr|td|title|html|body|head)|br)\b[^>]*>', chr(10), 'g'),
           '<[^>]*>', '', 'g') AS t
  FROM pages),
plain AS (
  SELECT page_id, host, replace(replace(replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&') AS t FROM own),
split AS (
  SELECT page_id, host, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines FROM plain),
totals AS (SELECT host, count(*) AS total FROM split GROUP BY host),
gone AS (
  SELECT host, list(line) AS gone FROM (
    SELECT host, line, count(*) AS pages FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM split) GROUP BY ALL)
  JOIN totals USING (host) WHERE pages >= 3 AND pages > 0.1 * total GROUP BY host),
kept AS (
  SELECT page_id, host, len(lines) AS n, list_filter(lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS k FROM split LEFT JOIN gone USING (host))
SELECT page_id, host, CAST(n AS BIGINT) AS n_lines, CAST(n - len(k) AS BIGINT) AS n_dropped, sha256(array_to_string(k, chr(10))) AS kept_sha256 FROM kept
"""

OP5 = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (SELECT doc_id, i, w[i : i + 4] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM docs WHERE len(w) >= 5)),
twice AS (SELECT doc_id, unnest(list(i)) AS i FROM windows GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY doc_id),
counted AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         len(list_filter(w[2 : len(w) - 1], lambda x: x IN ('the', 'of', 'and', 'to', 'in', 'de', 'la', 'le', 'les', 'que', 'der', 'die', 'und', 'el', 'los'))) AS n_stop
  FROM docs LEFT JOIN covered USING (doc_id)),
failed AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words >= 10 AND n_repeat_words / n_words <= 0.2
       AND word_chars / n_words BETWEEN 1.5 AND 25 AND n_symbols / n_words <= 0.25 AND n_bangs / n_words <= 0.5
       AND coalesce(n_dup_lines / nullif(n_lines, 0), 0) <= 0.6
       AND (n_words < 80 OR 0.01 * n_words - n_stop <= 0) AS kept
FROM failed
"""

OP7 = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE len(w) >= 50)),
firsts AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS gone FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN firsts USING (g) WHERE first < doc_id) GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM docs),
lost AS (SELECT doc_id, unnest(gone) AS p FROM gone),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n FROM words ANTI JOIN lost USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""


def _tokens(table: str, ident: str) -> str:
    flat = r"regexp_replace(regexp_replace(lower(coalesce(text, '')), '[.,;:!?\"''()\[\]]', '', 'g'), '[ \t\n\x0b\f\r]+', ' ', 'g')"
    return f"SELECT {ident}, list_filter(string_split({flat}, ' '), lambda x: x <> '') AS w FROM {table}"


OP9 = f"""
WITH docs AS ({_tokens('documents', 'doc_id')}), items AS ({_tokens('benchmark', 'item_id')}),
dt AS (SELECT doc_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS i FROM docs),
bt AS (SELECT item_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM items WHERE len(w) >= 8),
hits AS (
  SELECT doc_id, item_id, dt.i - bt.i AS off FROM dt JOIN bt USING (token)
  GROUP BY doc_id, item_id, dt.i - bt.i, n HAVING count(*) >= least(13, n) - 2),
laid AS (
  SELECT doc_id, item_id, off, p, CAST(coalesce(p + off > 0 AND d.w[p + off] = b.w[p], false) AS INT) AS same, len(b.w) AS n
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM hits JOIN items USING (item_id)) b JOIN docs d USING (doc_id)),
run AS (
  SELECT doc_id, item_id, n, p, least(13, n) AS width,
         sum(same) OVER (PARTITION BY doc_id, item_id, off ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS agreeing FROM laid),
found AS (SELECT doc_id, item_id, max(agreeing) AS agreeing FROM run WHERE agreeing >= width - 2 AND p + width - 1 <= n GROUP BY doc_id, item_id),
by_doc AS (SELECT doc_id, count(*) AS n_items, max(agreeing) AS agreeing FROM found GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, CAST(coalesce(agreeing, 0) AS BIGINT) AS agreeing
FROM docs LEFT JOIN by_doc USING (doc_id)
"""

OP13 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') FOR i IN range(1, len(w) - k + 2)]) AS phrase
  FROM cut, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 10),
longer AS (
  SELECT lang, part, max(a) AS inside
  FROM (SELECT lang, a, string_split(phrase, ' ') AS w, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part FROM f WHERE k = 3)
  GROUP BY ALL),
candidates AS (
  SELECT f.*, string_split(phrase, ' ') AS w FROM f LEFT JOIN longer ON f.lang = longer.lang AND phrase = part
  WHERE k > 1 AND (inside IS NULL OR 100 * inside < 50 * a)),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, 1000000 * c.a * c.a // (x.a * y.a) AS score, part_words
  FROM (SELECT *, unnest(range(1, k)) AS part_words FROM candidates) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:part_words], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[part_words + 1:], ' ')),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, part_words) AS place FROM cuts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op1_mix_sources": OP1, "op2_ngram_join": OP2, "op3_line_dedup": OP3, "op5_quality_rules": OP5, "op7_substring_dedup": OP7, "op9_decontamination": OP9, "op13_collocations": OP13}
