"""Plan-level helpers: lineage, keys, pipelines."""
