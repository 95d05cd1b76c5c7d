"""Column-level helpers: NULL semantics, recodes, dates."""
