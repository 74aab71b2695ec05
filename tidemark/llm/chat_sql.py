"""The DuckDB twin of the chat query."""

ORACLE = r"""
WITH turns AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS own, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, NULL, 1, 'assistant', '\### Assistant: </turn> ok'
), ordered AS (
  SELECT *, row_number() OVER w - 1 AS pos, coalesce(lag(role) OVER w, 'start') AS before,
    lead(role) OVER w IS NULL AS final,
    length(role) + (length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))) AS role_chars,
    length(text) + (length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '>', ''))) AS text_chars
  FROM turns WINDOW w AS (PARTITION BY conv_id, own ORDER BY turn NULLS FIRST, role, text)
), checked AS (
  SELECT *, NOT ((before = 'start' AND role IN ('system', 'user')) OR (before = 'system' AND role = 'user' AND pos = 1)
    OR (before = 'user' AND role = 'assistant') OR (before = 'assistant' AND role = 'user')) AS bad
  FROM ordered
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(6 + role_chars + 2 + text_chars + 8) AS BIGINT) AS formatted_chars,
  NOT bool_or(bad) AND max(CASE WHEN final THEN role END) = 'assistant' AS valid,
  CAST(min(pos) FILTER (bad) AS INTEGER) AS refused_turn
FROM checked GROUP BY conv_id, own
"""
