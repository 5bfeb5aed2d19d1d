"""Query of the fingerprints."""

from shelfcast.llm.registry import documents, query
from shelfcast.llm.weighted_sampling import neighbour_fingerprints


@query("op3_weighted_sampling")
def op3_weighted_sampling(spark, sf):
    """Fingerprints of all texts and edited texts, with their likeness."""
    return neighbour_fingerprints(documents(spark, sf))
