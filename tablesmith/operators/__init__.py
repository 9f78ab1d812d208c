"""DataFrame operators: version dedup, lookups, contracts, ids, upserts."""
