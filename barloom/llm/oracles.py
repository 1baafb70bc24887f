"""DuckDB counterparts of the corpus queries that SQL can express."""

from __future__ import annotations

RULES = r"""
WITH d AS (
  SELECT doc_id, lang, source, COALESCE(text, '') AS t,
         regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [x FOR x IN string_split(COALESCE(text, ''), chr(10))
          IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents),
g AS (
  SELECT doc_id, pos, COUNT(*) OVER (PARTITION BY doc_id, win) AS times FROM (
    SELECT doc_id, UNNEST(range(1, len(w) - 6)) AS pos, UNNEST([array_to_string(list_slice(w, i, i + 7), ' ')
           FOR i IN range(1, len(w) - 6)]) AS win FROM d WHERE len(w) >= 8)),
r AS (
  SELECT doc_id, CAST(SUM(LEAST(8, COALESCE(pos - before, 8))) AS BIGINT) AS n_repeat_words FROM (
    SELECT doc_id, pos, LAG(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before
    FROM g WHERE times > 1) GROUP BY doc_id),
m AS (
  SELECT doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         COALESCE(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
v AS (
  SELECT lang, source, rule, CASE WHEN value > 0 THEN CAST(CEIL(LN(value) / 0.01980262729617973) AS INT)
         ELSE -2147483648 END AS bucket
  FROM (SELECT lang, source, UNNEST(['symbol_share', 'dup_line_share', 'repeat_share', 'word_length']) AS rule,
               UNNEST([n_symbols / word_chars, n_dup_lines / n_lines, n_repeat_words / n_words,
                       word_chars / n_words]) AS value FROM m WHERE n_words > 0)),
s AS (
  SELECT lang, source, rule, bucket, 1 AS level FROM v
  UNION ALL SELECT lang, NULL, rule, bucket, 2 FROM v
  UNION ALL SELECT NULL, NULL, rule, bucket, 3 FROM v),
k AS (
  SELECT level, lang, source, rule, bucket, SUM(n) OVER (PARTITION BY level, lang, source, rule ORDER BY bucket) AS up_to,
         SUM(n) OVER (PARTITION BY level, lang, source, rule) AS total
  FROM (SELECT level, lang, source, rule, bucket, COUNT(*) AS n FROM s GROUP BY ALL)),
q AS (
  SELECT level, lang, source, rule, MAX(total) AS n,
         MIN(CASE WHEN 4 * up_to >= total THEN bucket END) AS b1,
         MIN(CASE WHEN 4 * up_to >= 3 * total THEN bucket END) AS b3
  FROM k GROUP BY level, lang, source, rule),
z AS (
  SELECT *, CASE WHEN b1 = -2147483648 THEN 0.0 ELSE POW(1.02::DOUBLE, b1) END AS q1,
         CASE WHEN b3 = -2147483648 THEN 0.0 ELSE POW(1.02::DOUBLE, b3) END AS q3 FROM q),
f AS (
  SELECT level, lang, source, rule, n,
         CASE WHEN rule = 'word_length' THEN q1 - 8 * GREATEST(q3 - q1, 0.3) END AS low,
         q3 + CASE WHEN rule = 'word_length' THEN 8 * GREATEST(q3 - q1, 0.3)
                   ELSE 6 * GREATEST(q3 - q1, CASE WHEN rule = 'symbol_share' THEN 0.02 ELSE 0.05 END) END AS high
  FROM z),
e AS (
  SELECT a.lang, a.source, a.rule,
         CASE WHEN a.n >= 200 THEN a.low WHEN b.n >= 200 THEN b.low ELSE c.low END AS low,
         CASE WHEN a.n >= 200 THEN a.high WHEN b.n >= 200 THEN b.high ELSE c.high END AS high
  FROM f a JOIN f b ON b.level = 2 AND a.lang IS NOT DISTINCT FROM b.lang AND a.rule = b.rule
           JOIN f c ON c.level = 3 AND a.rule = c.rule
  WHERE a.level = 1),
p AS (
  SELECT lang, source, MAX(CASE WHEN rule = 'symbol_share' THEN high END) AS h1,
         MAX(CASE WHEN rule = 'dup_line_share' THEN high END) AS h2,
         MAX(CASE WHEN rule = 'repeat_share' THEN high END) AS h3,
         MAX(CASE WHEN rule = 'word_length' THEN high END) AS h4,
         MAX(CASE WHEN rule = 'word_length' THEN low END) AS l4
  FROM e GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
       AND COALESCE(n_symbols / word_chars <= h1 AND n_dup_lines / n_lines <= h2
                    AND n_repeat_words / n_words <= h3 AND word_chars / n_words BETWEEN l4 AND h4, FALSE) AS kept
FROM m LEFT JOIN p ON m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source
"""

URLS = r"""
WITH u AS (
  SELECT page_id, NULLIF(regexp_replace(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)), '^www\.', ''), '') AS host,
         ([s FOR s IN string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/?([^?#]*)', 1), '/')
           IF s <> ''])[1:2] AS path,
         DATE '2024-01-01' + CAST((page_id * 37) % 366 AS INT) AS fetched
  FROM pages),
n AS (
  SELECT DISTINCT host AS pattern FROM u WHERE host IS NOT NULL
  UNION ALL
  SELECT pattern FROM (SELECT DISTINCT host || '/' || path[1] AS pattern FROM u
                       WHERE host IS NOT NULL AND len(path) > 0)
  WHERE CAST('0x' || substr(md5(pattern), 1, 1) AS INT) < 4),
x AS (
  SELECT pattern, CAST('0x' || substr(md5(pattern), 2, 1) AS INT) AS a,
         CAST('0x' || substr(md5(pattern), 3, 1) AS INT) AS b,
         DATE '2023-10-01' + CAST('0x' || substr(md5(pattern), 4, 2) AS INT) AS since,
         1 + CAST('0x' || substr(md5(pattern), 6, 2) AS INT) AS later
  FROM n),
i AS (
  SELECT pattern, CASE WHEN a < 10 THEN 'block' ELSE 'allow' END AS action, since, since + later AS until FROM x
  UNION ALL
  SELECT pattern, CASE WHEN b < 6 THEN 'lift' WHEN b < 11 THEN 'allow' ELSE 'block' END,
         since + later, DATE '9999-12-31' FROM x),
c AS (
  SELECT page_id, fetched, array_to_string(parts[k:], '.') AS pattern, len(parts) - k + 1 AS specificity
  FROM (SELECT *, UNNEST(range(1, len(parts) + 1)) AS k
        FROM (SELECT *, string_split(host, '.') AS parts FROM u WHERE host IS NOT NULL))
  UNION ALL
  SELECT page_id, fetched, host || '/' || array_to_string(path[1:k], '/'), len(string_split(host, '.')) + k
  FROM (SELECT *, UNNEST(range(1, len(path) + 1)) AS k FROM u WHERE host IS NOT NULL)),
j AS (
  SELECT page_id, c.pattern, specificity, action FROM c JOIN i
  ON c.pattern = i.pattern AND action <> 'lift' AND since <= fetched AND fetched < until)
SELECT p.page_id, COALESCE(n_active, 0) AS n_active, best.pattern AS decided_by, best.action AS action,
       COALESCE(best.action = 'block', FALSE) AS blocked
FROM pages p LEFT JOIN (
  SELECT page_id, COUNT(DISTINCT pattern) AS n_active,
         MAX(struct_pack(specificity := specificity, pattern := pattern, action := action)) AS best
  FROM j GROUP BY page_id) USING (page_id)
"""

EXACT = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, MIN(doc_id) OVER (PARTITION BY t) AS keep_id, COUNT(*) OVER (PARTITION BY t) AS group_size,
       doc_id = MIN(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t
"""

CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS t FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (
  SELECT *, replace(replace(replace(t, '\', '\0'), '</turn>', '\1'), '### ', '\2') AS et,
         replace(replace(replace(replace(role, '\', '\0'), '</turn>', '\1'), '### ', '\2'), chr(10), '\3') AS er
  FROM r)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, role, t)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(t) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(CASE WHEN role = 'assistant' THEN t END, '' ORDER BY turn NULLS FIRST, role, t), ''))
         AS loss_sha256,
       CAST(SUM(4 + length(er) + 1 + length(et) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


CLUSTERS_START = """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
         [CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) FOR c IN embedding] AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, x) - 1 AS c, x FROM (
    SELECT sha256('3:' || COALESCE(CAST(vec_id AS VARCHAR), '')) AS h, x FROM kept ORDER BY h, x LIMIT 8))"""

# Nearest centroid (ties: smaller number), then sums per cluster and dimension, divided downwards.
CLUSTERS_ROUND = """,
a{n} AS MATERIALIZED (
  SELECT row, vec_id, x, MIN(key) % 8 AS c, MIN(key) // 8 AS distance FROM (
    SELECT k.row, k.vec_id, k.x, s.c + 8 * CAST(list_sum(
             [(k.x[i] - s.x[i]) * (k.x[i] - s.x[i]) FOR i IN range(1, 65)]) AS BIGINT) AS key
    FROM kept k CROSS JOIN s{n} s)
  GROUP BY row, vec_id, x),
s{m} AS MATERIALIZED (
  SELECT s.c, COALESCE(f.x, s.x) AS x FROM s{n} s LEFT JOIN (
    SELECT c, list(CAST((v - ((v % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
      SELECT c, i, SUM(v) AS v, COUNT(*) AS n FROM (
        SELECT c, UNNEST(range(1, 65)) AS i, UNNEST(x) AS v FROM a{n}) GROUP BY c, i)
    GROUP BY c) f USING (c))"""

CLUSTERS_END = """
SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(SUM(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(SUM(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(s.x, ',')) AS centroid_sha256
FROM a10 a JOIN s10 s USING (c)
"""

CLUSTERS = (
    CLUSTERS_START
    + "".join(CLUSTERS_ROUND.format(n=n, m=n + 1) for n in range(11))
    + CLUSTERS_END
)


def llm_oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": RULES,
        "op2_url_filters": URLS,
        "op9_chat_formatting": CHAT,
        "op10_exact_dedup": EXACT,
        "op11_centroid_clusters": CLUSTERS,
    }
