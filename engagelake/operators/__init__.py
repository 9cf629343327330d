"""Reusable DataFrame operators: latest-by / dedup, size-checked broadcast, skew-safe distinct
counts, quality rules, privacy guard, schema-free JSON."""
