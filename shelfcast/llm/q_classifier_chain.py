"""Query of the toxicity chain."""

from pyspark.sql import functions as F

from shelfcast.llm.classifier_chain import learn_chain, score_chain
from shelfcast.llm.q_rule_ensemble import held_out
from shelfcast.llm.registry import documents, query

# The table has one label, so the earlier categories are weak ones: toxic texts that call names or express
# contempt in these words. The last category is the label itself.
NAMES = "idiot moron clown loser scum trash".split()
CONTEMPT = "stupid pathetic worthless disgusting".split()


def _says(words):
    return F.col("text").rlike(rf"(?i)\b({'|'.join(words)})\b")


def categories():
    """(name, condition) in the order of the chain."""
    toxic = F.col("__toxic") == 1
    return [("p_name_calling", toxic & _says(NAMES)), ("p_contempt", toxic & _says(CONTEMPT)), ("p_toxic", toxic)]


@query("op9_classifier_chain")
def op9_classifier_chain(spark, sf):
    """Probabilities of three categories for every document; a fifth of the ids is never learned from."""
    docs = documents(spark, sf)
    order = categories()
    chain = learn_chain(docs, spark.read.parquet(f"{sf}/labels.parquet"), order, ~held_out(5, 0))
    names = [n for n, _ in order]
    rows = score_chain(docs.select("doc_id", "text"), chain, names)
    return rows.select("doc_id", held_out(5, 0).alias("held_out"), *names, (F.col("p_toxic") >= 0.5).cast("int").alias("toxic"))
