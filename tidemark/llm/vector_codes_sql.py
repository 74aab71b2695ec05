"""The DuckDB twin of the vector code query: every part compared with every entry, round after round."""

PARTS, ENTRIES, ROUNDS = 8, 16, 6


def _assigned(name: str, books: str) -> str:
    """Each part's nearest entry, and the squared distance."""
    distance = "list_sum(list_transform(list_zip(s.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    return f"""{name} AS MATERIALIZED (
  SELECT vec_id, part, v, best.entry AS entry, best.distance AS distance FROM (
    SELECT s.vec_id, s.part, any_value(s.v) AS v, min({{'distance': {distance}, 'entry': b.entry}}) AS best
    FROM split s JOIN {books} b ON s.part = b.part GROUP BY s.vec_id, s.part))"""


def _updated(name: str, books: str, assigned: str) -> str:
    """Each entry's mean, rounded down, or the entry itself if no part is its own."""
    return f"""{name} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM {books} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY place) AS v FROM (
      SELECT part, entry, place, (sum(x) - (((sum(x) % count(*)) + count(*)) % count(*)))::HUGEINT // count(*) AS mean FROM (
        SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM {assigned}) GROUP BY part, entry, place) GROUP BY part, entry) m
  ON b.part = m.part AND b.entry = m.entry)"""


def _oracle() -> str:
    steps = [
        """kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""split AS MATERIALIZED (
  SELECT vec_id, part, q[part * (len(q) // {PARTS}) + 1 : (part + 1) * (len(q) // {PARTS})] AS v FROM kept, range({PARTS}) AS r(part))""",
        f"""b0 AS MATERIALIZED (
  SELECT part, n - 1 AS entry, v FROM split JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS n FROM kept QUALIFY n <= {ENTRIES}) USING (vec_id))""",
    ]
    for n in range(ROUNDS):
        steps += [_assigned(f"a{n}", f"b{n}"), _updated(f"b{n + 1}", f"b{n}", f"a{n}")]
    steps += [
        _assigned("last", f"b{ROUNDS}"),
        f"digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})",
        """coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error FROM last GROUP BY vec_id)""",
    ]
    return "WITH " + ",\n".join(steps) + """
SELECT c.vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded c JOIN kept USING (vec_id), digest
"""


ORACLE = _oracle()
