"""What the test modules share; in a module of its own, as each folder's conftest.py has the same name."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Collect as plain tuples (tests only, small fixtures)."""
    cols = cols or tuple(df.columns)
    return [tuple(r[c] for c in cols) for r in df.collect()]
