"""Rows of frames for comparisons in tests."""


def got(df, *columns):
    """Rows of a frame as a sorted list of tuples."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))
