"""DataFrame-level operators (joins, pickers, reshapes, keys, periods, fuzzy matching, gates)."""
