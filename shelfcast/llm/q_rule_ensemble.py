"""Query of the quality classifier."""

from pyspark.sql import functions as F

from shelfcast.llm.registry import documents, query
from shelfcast.llm.rule_ensemble import learn_quality, score_quality

THRESHOLD = 0.3


def held_out(divisor: int, rest: int):
    """crc32 of the id as text, modulo the divisor."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % divisor == rest, F.lit(False))


@query("op4_rule_ensemble")
def op4_rule_ensemble(spark, sf):
    """Quality score of every document, learned from four fifths of the labels."""
    docs = documents(spark, sf)
    model = learn_quality(docs, spark.read.parquet(f"{sf}/labels.parquet"), ~held_out(5, 0))
    rows = score_quality(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", held_out(5, 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted")
    )
