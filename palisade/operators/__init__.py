"""DataFrame operators: screening, deduplication, ranking, conforming, reporting."""
