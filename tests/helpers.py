"""Helpers of the tests that are no fixtures."""


def rows(df):
    """The rows as sorted tuples; nulls sort first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])
