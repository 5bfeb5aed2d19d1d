"""Query of the quality rules."""

from pyspark.sql import functions as F

from shelfcast.llm.quality_rules import STOP_WORDS, apply_rules
from shelfcast.llm.registry import documents, query

_STOPS = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
_WORD = r"[^\x20\x09-\x0D]+"


@query(
    "op7_quality_rules",
    rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT r, i, x FROM (SELECT r, unnest(regexp_extract_all(t, '{_WORD}')) AS x,
                                      generate_subscripts(regexp_extract_all(t, '{_WORD}'), 1) AS i FROM d)),
    g AS (SELECT r, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
    f AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) > 1 AND g IS NOT NULL AS hit FROM g),
    c AS (SELECT r, max(hit::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c FROM f),
    rep AS (SELECT r, sum(c)::BIGINT AS n FROM c GROUP BY r),
    ws AS (SELECT r, count(*) AS n, sum(length(x))::BIGINT AS chars, count(*) FILTER (WHERE x IN ({_STOPS})) AS stops FROM w GROUP BY r),
    l AS (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d),
    ls AS (SELECT r, count(*) AS n, count(DISTINCT x) AS k FROM l WHERE regexp_matches(x, '{_WORD}') GROUP BY r),
    s AS (SELECT d.doc_id, coalesce(ws.n, 0) AS n_words, coalesce(ws.chars, 0) AS word_chars, coalesce(ws.stops, 0) AS stops,
                 length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols, coalesce(ls.n - ls.k, 0) AS n_dup_lines,
                 coalesce(ls.n, 0) AS n_lines, coalesce(rep.n, 0) AS n_repeat_words, length(t) - length(replace(t, '!', '')) AS bangs,
                 length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS capitals
          FROM d LEFT JOIN ws USING (r) LEFT JOIN ls USING (r) LEFT JOIN rep USING (r)),
    b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s)
    SELECT doc_id, n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AND n_symbols <= 0.06::DOUBLE * word_chars
           AND bangs <= 0.3::DOUBLE * n_words AND capitals <= 0.4::DOUBLE * word_chars
           AND stops >= 0.02::DOUBLE * n_words AND n_dup_lines <= 0.5::DOUBLE * n_lines AS kept
    FROM b""",
)
def op7_quality_rules(spark, sf):
    """Statistics and verdict of every document."""
    rows = apply_rules(documents(spark, sf).select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return rows.select("doc_id", *[F.col("quality.stats")[n].cast("long").alias(n) for n in names], "quality.base_failed", "quality.kept")
