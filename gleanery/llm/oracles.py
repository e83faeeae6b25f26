"""SQL of the queries that SQL can express, written without the operators' methods."""

SPACE = r"[\x20\x09-\x0D]+"
_WORDS = f"list_filter(string_split_regex({{}}, '{SPACE}'), lambda x: x <> '')"

#: Sets of words by line; pairs that share a word of their prefix in order of rarity; later ones go.
LINE_DEDUP = f"""WITH lines AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
worded AS (SELECT *, list_sort(list_distinct({_WORDS.format('line')})) AS s FROM lines),
sets AS (SELECT s, len(s) AS size, min((doc_id, n)) AS place FROM worded WHERE len(s) > 0 GROUP BY s),
exploded AS (SELECT place, size, s, unnest(s) AS w FROM sets),
common AS (SELECT w, count(*) AS df FROM exploded GROUP BY w),
ranked AS (SELECT place, size, s, w, row_number() OVER (PARTITION BY place ORDER BY df, w) AS pos
  FROM exploded JOIN common USING (w)),
prefix AS (SELECT * FROM ranked WHERE pos <= size - ceil(0.8 * size - 1e-9) + 1),
pairs AS (SELECT DISTINCT a.place AS a, a.s AS x, b.place AS b, b.s AS y FROM prefix a JOIN prefix b
  ON a.w = b.w AND a.place < b.place AND least(a.size, b.size) >= 0.8 * greatest(a.size, b.size) - 1e-9),
gone AS (SELECT DISTINCT b FROM pairs
  WHERE len(list_intersect(x, y)) >= 0.8 * (len(x) + len(y) - len(list_intersect(x, y))) - 1e-9),
kept AS (SELECT place FROM sets WHERE place NOT IN (SELECT b FROM gone)),
left_over AS (SELECT l.*, len(l.s) = 0 OR k.place IS NOT NULL AS stays FROM worded l LEFT JOIN kept k ON k.place = (l.doc_id, l.n))
SELECT doc_id, CASE WHEN any_value(text) IS NOT NULL THEN
  coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (stays), '') END AS text FROM left_over GROUP BY doc_id"""

QUALITY_RULES = f"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_WORDS.format('text')} AS ws,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM t),
grams AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
base AS (SELECT doc_id, text, ws, lines, len(ws) AS n_words,
  CAST(list_sum(list_transform(ws, lambda x: length(x))) AS BIGINT) AS chars,
  CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, coalesce(chars, 0) AS word_chars, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
  AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= n_words
  AND 10 * n_dup_lines <= 3 * len(lines)
  AND 2 * (length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g'))) <= word_chars
  AND 5 * (length(text) - length(replace(text, '!', ''))) <= n_words
  AND 20 * len(list_distinct(ws)) >= least(n_words, 20000)
  AND 10 * len(list_filter(ws, lambda x: regexp_matches(x, '\\p{{L}}'))) >= 7 * n_words
  AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '^\\s*[-*•]'))) <= 9 * len(lines)
  AND 10 * len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$'))) <= 3 * len(lines) AS kept
FROM judged"""

TOP_K = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.v, d.v) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 20"""

#: All phrases of up to five words of every piece; cuts by joins with the counts of both parts.
COLLOCATIONS = """WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
worded AS MATERIALIZED (SELECT lang, row_number() OVER () AS id, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
each AS (SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM worded),
led AS MATERIALIZED (SELECT lang, w1, lead(w1, 1) OVER p AS w2, lead(w1, 2) OVER p AS w3, lead(w1, 3) OVER p AS w4, lead(w1, 4) OVER p AS w5
  FROM each WINDOW p AS (PARTITION BY id ORDER BY i)),
grams AS (SELECT lang, 1 AS k, w1 AS phrase FROM led UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM led WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, concat_ws(' ', w1, w2, w3) FROM led WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, concat_ws(' ', w1, w2, w3, w4) FROM led WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, concat_ws(' ', w1, w2, w3, w4, w5) FROM led WHERE w5 IS NOT NULL),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
counts AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS f, string_split(phrase, ' ') AS w FROM grams GROUP BY lang, phrase, k HAVING count(*) >= 100),
cuts AS (SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, n,
    CAST((1000::HUGEINT * c.f * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM counts c JOIN (SELECT unnest([1, 2, 3, 4]) AS j) ON j < c.k JOIN totals t ON t.lang = c.lang
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:j], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, f FROM counts,
  (SELECT unnest(range(1, 6)) AS i), (SELECT unnest(range(2, 5)) AS m) WHERE m < k AND i + m - 1 <= k)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM lowest o WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = o.lang AND i.phrase = o.phrase AND 100 * i.f >= 100 * o.a)
QUALIFY rank <= 2000"""
