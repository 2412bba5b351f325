"""DataFrame operators: cleaning, schema, latest rows, changes, enrichment, JSON."""
