"""DataFrame operators: topics, sliding counts, paging, enrichment, history, watch, long-term trends."""
