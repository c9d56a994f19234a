"""DataFrame operators: counts, scoring, ranking, search, incremental cuts and upserts."""
