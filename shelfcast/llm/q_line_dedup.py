"""Query of the line dedup."""

from pyspark.sql import functions as F

from shelfcast.llm.line_dedup import drop_repeated_lines
from shelfcast.llm.registry import documents, query


@query("op10_line_dedup")
def op10_line_dedup(spark, sf):
    """Of every document: the lines that go as later copies, and the digest of what stays."""
    rows = drop_repeated_lines(documents(spark, sf).select("doc_id", "text"), removed="removed_lines")
    return rows.select(
        "doc_id", F.size("removed_lines").cast("long").alias("n_removed"), "removed_lines",
        F.length("text").cast("long").alias("n_chars_kept"), F.sha2("text", 256).alias("kept_sha256"),
    )
