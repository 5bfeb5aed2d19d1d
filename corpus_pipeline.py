"""From raw documents to packed training sequences, one written table per stage.

Every stage works on all that its predecessor kept and returns the columns of ``documents``; the last one
returns the pieces of the packed sequences. The operators' docstrings state what becomes of nulls, empty
texts and repeated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.jaccard_join import one_per_component
from shelfcast.llm.line_dedup import drop_repeated_lines
from shelfcast.llm.mixing import mixed_documents
from shelfcast.llm.packing import pack_documents
from shelfcast.llm.q_packing import tokenizer_path
from shelfcast.llm.q_rule_ensemble import THRESHOLD
from shelfcast.llm.rule_ensemble import learn_quality, score_quality
from shelfcast.session import table_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble does not reject; it learns from all labels of ``docs``.

    A null text is scored as an empty one; repeated rows are judged alike.
    """
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), F.lit(True))
    return score_quality(docs, model, into="__score").filter(F.col("__score") >= THRESHOLD).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of repeated line runs; n_chars follows the text.

    A document that had words and of which the cut leaves none was nothing but later copies: it goes, so that no later
    stage packs an empty text. One that held no words before is not touched. A null text stays null; of repeated rows all but one go.
    """
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    out = drop_repeated_lines(docs.withColumn("__had_words", has_words)).filter(has_words | ~F.col("__had_words"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near-duplicates.

    Texts without words link with nothing and stay; a row with a null id stays only if its group has no other id.
    """
    return one_per_component(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it; a null source is one of its own, a null text has no words."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the packed sequences; a text without tokens is a piece of its end id."""
    rows = pack_documents(docs.select("doc_id", "text"), tokenizer_path())
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# A fitted classifier and seeded rounding have no SQL form; the tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = table_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
