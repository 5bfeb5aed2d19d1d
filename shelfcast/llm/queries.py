"""All queries of the subpackage; importing this module registers them."""

from shelfcast.llm import q_classifier_chain, q_fill_in_middle, q_jaccard_join, q_language_id, q_license_scan, q_line_dedup, q_merkle_audit, q_mixing, q_packing, q_prefix_trie, q_quality_rules, q_rule_ensemble, q_weighted_sampling  # noqa: F401
from shelfcast.llm.registry import QUERIES, SQL  # noqa: F401
