"""Query of the language identification."""

from shelfcast.llm.language_id import learn_languages, predict_languages
from shelfcast.llm.q_rule_ensemble import held_out
from shelfcast.llm.registry import documents, query


@query("op2_byte_gru")
def op2_byte_gru(spark, sf):
    """Language of every document; a quarter of the ids is never learned from."""
    docs = documents(spark, sf)
    network = learn_languages(docs.select("doc_id", "text", "lang"), ~held_out(4, 2))
    rows = predict_languages(docs.select("doc_id", "text"), network)
    return rows.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
