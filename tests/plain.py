"""Frames as plain Python values, for comparison in tests."""


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, for order-free comparison."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
