"""Column functions: text analysis, record codec, predicates and HTML fields."""
