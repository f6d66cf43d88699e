"""What tests compare."""


def rows(df, *cols):
    """Sorted tuples of a DataFrame."""
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
