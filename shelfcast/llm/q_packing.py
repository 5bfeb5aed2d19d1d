"""Query of the packing."""

import os

from shelfcast.llm.packing import pack_documents
from shelfcast.llm.registry import documents, query


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary files are installed; every machine has them."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark, sf):
    """All documents in sequences of 4096 tokens."""
    rows = pack_documents(documents(spark, sf).select("doc_id", "text"), tokenizer_path())
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
