"""Query of the mix."""

from pyspark.sql import functions as F

from shelfcast.llm.mixing import mix
from shelfcast.llm.registry import documents, query


@query("op6_pivotal_mixing")
def op6_pivotal_mixing(spark, sf):
    """Words that the mix takes of every document."""
    rows = mix(documents(spark, sf))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
