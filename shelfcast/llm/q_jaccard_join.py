"""Query of the near-duplicate groups."""

from shelfcast.llm.jaccard_join import similar_components
from shelfcast.llm.registry import documents, query


@query("op8_grouped_prefix_join")
def op8_grouped_prefix_join(spark, sf):
    """Component of every document under Jaccard links of 0.75 on five-word shingles."""
    return similar_components(documents(spark, sf))
