"""Query of the fixity audit."""

from pyspark.sql import functions as F

from shelfcast.llm.merkle_audit import audit
from shelfcast.llm.registry import query

_RECORD = (
    "'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'none') || '>' "
    "|| chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' || strlen(coalesce(html, '')) "
    "|| chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"
)


def damaged(pages):
    """A replica of the pages with known damage: changed bytes, truncated payloads, lost and foreign records."""
    kind = F.col("page_id") % 211
    html = (
        F.when(kind == 5, F.concat(F.lit("X"), F.substring(F.coalesce("html", F.lit("")), F.lit(2), F.length("html"))))
        .when(kind == 77, F.substring(F.col("html"), F.lit(1), F.floor(F.length("html") / 2).cast("int")))
        .otherwise(F.col("html"))
    )
    page_id = F.when(kind == 150, -F.col("page_id") - 1).otherwise(F.col("page_id"))
    return pages.filter(F.coalesce(kind, F.lit(0)) != 100).select(page_id.alias("page_id"), "url", html.alias("html"))


@query(
    "op5_merkle_audit",
    f"""WITH b0 AS (SELECT CASE WHEN page_id % 211 = 150 THEN -page_id - 1 ELSE page_id END AS page_id, url,
                CASE WHEN page_id % 211 = 5 THEN 'X' || substring(coalesce(html, ''), 2, length(html))
                     WHEN page_id % 211 = 77 THEN substring(html, 1, (length(html) // 2)::INT) ELSE html END AS html
         FROM pages WHERE coalesce(page_id % 211, 0) <> 100),
    ra AS (SELECT page_id, {_RECORD} AS r FROM pages), rb AS (SELECT page_id, {_RECORD} AS r FROM b0),
    da AS (SELECT page_id, strlen(r)::BIGINT AS length, sha256(r) AS digest, row_number() OVER (PARTITION BY page_id ORDER BY sha256(r)) - 1 AS number FROM ra),
    db AS (SELECT page_id, strlen(r)::BIGINT AS length, sha256(r) AS digest, row_number() OVER (PARTITION BY page_id ORDER BY sha256(r)) - 1 AS number FROM rb),
    f AS (SELECT greatest(16, ceil(sum(length) / 268435456.0))::BIGINT AS files FROM da),
    m AS (SELECT ((coalesce(page_id, 0) % files + files) % files)::INT AS file, da.* FROM da, f),
    o AS (SELECT *, (sum(length) OVER (PARTITION BY file ORDER BY page_id NULLS FIRST, number) - length)::BIGINT AS "offset" FROM m)
    SELECT o.file, o."offset", o.length, o.page_id, o.number, CASE WHEN db.digest IS NULL THEN 'missing' ELSE 'changed' END AS status, o.digest AS expected, db.digest AS found
    FROM o LEFT JOIN db ON o.page_id IS NOT DISTINCT FROM db.page_id AND o.number = db.number WHERE db.digest IS DISTINCT FROM o.digest
    UNION ALL
    SELECT NULL, NULL, db.length, db.page_id, db.number, 'extra', NULL, db.digest
    FROM db WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.page_id IS NOT DISTINCT FROM db.page_id AND o.number = db.number)""",
)
def op5_merkle_audit(spark, sf):
    """Damage of a replica of all pages, located by descending Merkle trees."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    return audit(pages, damaged(pages))
