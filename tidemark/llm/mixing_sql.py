"""The DuckDB twin of the mixing query (target entropy 0.9, at most 2 readings, blocks of a million words)."""

ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens FROM documents
), totals AS (
  SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM sized GROUP BY source
), whole AS (
  SELECT CAST(sum(tokens) AS BIGINT) AS total FROM totals
), shares AS (
  SELECT list(CAST(tokens AS DOUBLE) / total ORDER BY source) AS p FROM totals, whole WHERE tokens > 0
), tries(step, low, high) AS (
  SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)
  UNION ALL
  SELECT step + 1, CASE WHEN enough THEN middle ELSE low END, CASE WHEN enough THEN high ELSE middle END FROM (
    SELECT step, low, high, middle,
      ln(z) - middle * zl / z >= 0.9 * ln(len(p)) - 1e-12 OR pow(list_max(p) / list_min(p), 1 - middle) >= 2.0 AS enough
    FROM (SELECT t.step, t.low, t.high, (t.low + t.high) / 2 AS middle, s.p,
        list_sum(list_transform(s.p, lambda x: pow(x, (t.low + t.high) / 2))) AS z,
        list_sum(list_transform(s.p, lambda x: pow(x, (t.low + t.high) / 2) * ln(x))) AS zl
      FROM tries t, shares s WHERE t.step < 50)
  )
), chosen AS (
  SELECT CASE WHEN -list_sum(list_transform(p, lambda x: x * ln(x))) >= 0.9 * ln(len(p)) - 1e-12 OR 1.0 >= 2.0 THEN CAST(1 AS DOUBLE) ELSE low END AS a
  FROM tries, shares WHERE step = 50
), passed AS (
  SELECT source, tokens,
    CASE WHEN tokens > 0 THEN floor(pow(CAST(tokens AS DOUBLE) / total / list_max(p), a - 1) * 1e9 + 0.5) / 1e9 ELSE 1.0 END AS passes
  FROM totals, whole, shares, chosen
), planned AS (
  SELECT *, CAST(floor(passes) AS BIGINT) AS fulls, CAST(floor((passes - floor(passes)) * tokens) AS BIGINT) AS rest,
    CAST(greatest(ceil(sum(tokens * passes) OVER () / 1000000), 1) AS BIGINT) AS blocks
  FROM passed
), copies AS (
  SELECT doc_id, s.source, n_tokens, tokens, passes, fulls, rest, blocks, unnest(generate_series(0, fulls - CASE WHEN rest > 0 THEN 0 ELSE 1 END)) AS pass
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
), hashed AS (
  SELECT *, CAST('0x' || substr(md5('mix:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS h FROM copies
), ended AS (
  SELECT *, CAST(sum(n_tokens) OVER (PARTITION BY source, pass ORDER BY h, doc_id, n_tokens ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM hashed
), dealt AS (
  SELECT doc_id, source, n_tokens, pass,
    CASE WHEN tokens > 0 THEN least(CAST(floor((pass * tokens + upto - n_tokens) / (tokens * passes / blocks)) AS BIGINT), blocks - 1) ELSE o % blocks END AS block, o
  FROM (SELECT *, CAST('0x' || substr(md5('mix-block:' || pass || ':' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15) AS BIGINT) AS o FROM ended) WHERE pass < fulls OR upto <= rest
)
SELECT doc_id, source, n_tokens, pass, block,
  row_number() OVER (PARTITION BY block ORDER BY o, doc_id, pass, n_tokens, source) - 1 AS place
FROM dealt
"""
