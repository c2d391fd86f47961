"""Queries and SQL of the library's own operators, by name."""

from scriptorium.plans import curation_queries, entity_queries, library_queries, matching_queries, people_queries, line_queries, citation_queries, merging_queries, names_queries, reference_queries, table_queries, text_queries  # noqa: F401
from scriptorium.plans.catalogue import ORACLES, QUERIES  # noqa: F401

FLAGSHIP = "ref3_quality_summary"
