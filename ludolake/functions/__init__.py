"""Column-level building blocks: features, predicates, time helpers, review text."""
