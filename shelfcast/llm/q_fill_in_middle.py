"""Query of the fill-in-the-middle transformation."""

from pyspark.sql import functions as F

from shelfcast.llm.fill_in_middle import fill_in_middle, restored
from shelfcast.llm.registry import documents, query


@query(
    "op12_boundary_set",
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT *, length(x)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
                 ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
    v AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
                 CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
    w AS (SELECT *, substring(x, 1, a) AS p, substring(x, a + 1, z - a) AS m, substring(x, z + 1, n - z) AS s FROM v)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN z - a END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(x) AS restored_sha256
    FROM w""",
)
def op12_boundary_set(spark, sf):
    """Cuts of every document, and digests of its output and of the text rebuilt from it."""
    rows = fill_in_middle(documents(spark, sf).select("doc_id", "text")).select("doc_id", "fim.*")
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
