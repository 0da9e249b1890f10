"""DataFrame operators: shredding, extraction, loading, keys, quality."""
