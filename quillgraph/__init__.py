"""Letters to knowledge graph, as DataFrame and SQL operators."""
