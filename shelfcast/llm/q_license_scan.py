"""Query of the licence scan; the SQL matches the same rules with joins in place of expressions."""

from pyspark.sql import functions as F

from shelfcast.llm.license_rules import REACH, rules
from shelfcast.llm.license_scan import OUTSIDE, labels, ranked, scan_licenses
from shelfcast.llm.registry import documents, query


def _sql() -> str:
    text = lambda x: "'" + x.replace("'", "''") + "'"
    table = ", ".join(
        f"({k}, {text(r.label)}, {text(f' ({r.pattern}) ')}, {text(r.anchor)}, {text(r.keyword)}, {r.priority}, {r.weight}::DOUBLE, {r.base})"
        for k, r in enumerate(ranked(rules()))
    )
    return rf"""WITH rule(k, label, pattern, anchor, keyword, priority, weight, base) AS (VALUES {table}),
    d AS (SELECT row_number() OVER () AS r, doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '{OUTSIDE}', ' ', 'g')), ' ') AS w FROM documents),
    p AS (SELECT r, w, i - 1 AS i, w[i] AS x FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d) WHERE w[i] IN (SELECT anchor FROM rule)),
    s AS (SELECT r, i, x, ' ' || array_to_string(w[greatest(i - {REACH}, 0) + 1 : i], ' ') || ' #' || x || ' ' ||
                 array_to_string(w[i + 2 : i + 1 + {REACH}], ' ') || ' ' AS t FROM p),
    m AS (SELECT r, i, k, label, priority, weight, base, regexp_extract(t, pattern, 1) AS t FROM s JOIN rule ON x = anchor AND contains(t, keyword)),
    f AS (SELECT *, i - (length(a) - length(replace(a, ' ', ''))) AS b, i - (length(a) - length(replace(a, ' ', ''))) + length(t) - length(replace(t, ' ', '')) + 1 AS e
          FROM (SELECT *, split_part(t, '#', 1) AS a FROM m WHERE t <> '')),
    g AS (SELECT *, base OR NOT EXISTS (SELECT 1 FROM f y WHERE y.r = f.r AND y.b <= f.b AND y.e >= f.e AND y.priority >= f.priority
                 AND (y.priority > f.priority OR y.b < f.b OR y.e > f.e OR y.k < f.k)) AS kept FROM f),
    o AS (SELECT r, count(*) FILTER (WHERE base) AS n, min(b) FILTER (WHERE base) AS lo, max(b) FILTER (WHERE base) AS hi,
                 list_sort(list(DISTINCT label) FILTER (WHERE base)) AS bl, list_sort(list(DISTINCT label) FILTER (WHERE kept)) AS al,
                 max(weight) FILTER (WHERE kept) AS score FROM g GROUP BY r)
    SELECT doc_id, CASE WHEN w = [''] THEN 0 ELSE len(w) END::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
           coalesce(array_to_string(bl, ','), '') AS base_labels, coalesce(array_to_string(al, ','), '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM d LEFT JOIN o USING (r)"""


@query("op11_signature_rules", _sql())
def op11_signature_rules(spark, sf):
    """Places of the base phrases, labels and score of every document."""
    rows = scan_licenses(documents(spark, sf).select("doc_id", "text")).select("doc_id", "licenses.*")
    rows = rows.withColumn("base", F.filter("detections", lambda d: d["base"]))
    starts = F.transform("base", lambda d: d["start"].cast("long"))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.filter("detections", lambda d: d["kept"])).alias("labels"), "score",
    )
