"""Reusable DataFrame operators: latest-version dedup, first-per-key,
null-key-split left join, incremental window, keyed merge, versioned tables."""
