"""Query of the conversation prefix trie."""

from shelfcast.llm.prefix_trie import trie
from shelfcast.llm.registry import query


def crc32_sql(x: str) -> str:
    """Unsigned CRC-32 of a short ASCII text: bit by bit, as DuckDB has no such function."""
    return (
        f"(SELECT xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({x}, ''), lambda c: ascii(c)::BIGINT)), "
        "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END))))"
    )


@query(
    "op13_euler_tour",
    f"""WITH o AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
    p AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || x)) AS pos,
                 sha256(length(role) || ':' || role || x) AS k, length(x) AS n FROM o),
    v AS (SELECT c, c - c % 100 AS b, {crc32_sql("c::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT c FROM o)),
    r AS (SELECT v.c, pos AS i, k, n FROM v JOIN p ON p.c = v.b AND pos <= h
          UNION ALL SELECT v.c, pos - h + coalesce(m, 0), k, n FROM v JOIN p ON p.c = v.c AND pos > h
          LEFT JOIN (SELECT v.c AS c, count(*) AS m FROM v JOIN p ON p.c = v.b AND pos <= h GROUP BY 1) s ON s.c = v.c),
    q AS (SELECT c, i, n, sha256(string_agg(k, '') OVER (PARTITION BY c ORDER BY i)) AS key FROM r
          UNION ALL SELECT c, 0, 0, '' FROM v),
    z AS (SELECT c, max(i) AS last FROM q GROUP BY c),
    t AS (SELECT i, key, count(*) AS n_convs, min(c) AS id, max(n) AS n,
                 sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE i = last), '')) AS ends FROM q JOIN z USING (c) GROUP BY i, key),
    u AS (SELECT t.*, w.key AS up FROM t LEFT JOIN q w ON w.c = t.id AND w.i = t.i - 1),
    e AS (SELECT i, up, count(*) AS kids FROM u WHERE i > 0 GROUP BY ALL),
    f AS (SELECT u.*, a.id AS parent, coalesce(kids, 0) AS kids FROM u LEFT JOIN t a ON a.i = u.i - 1 AND a.key = u.up LEFT JOIN e ON e.i = u.i + 1 AND e.up = u.key),
    s AS (SELECT w.i, w.key, sum((f.kids = 0)::INT) AS leaves, sum((f.n_convs - 1) * f.n) AS saved FROM f JOIN q w ON w.c = f.id AND w.i <= f.i GROUP BY ALL)
    SELECT id AS conv_id, i::BIGINT AS depth, parent AS parent_conv_id, n_convs, kids::BIGINT AS n_children, leaves::BIGINT AS n_leaves,
           saved::BIGINT AS saved_tokens, ends AS ends_sha256 FROM f JOIN s USING (i, key)""",
)
def op13_euler_tour(spark, sf):
    """Nodes of the trie of all rebuilt conversations."""
    return trie(spark.read.parquet(f"{sf}/conversations.parquet"))
