"""Helpers of the tests; not in conftest, whose name other test folders share."""

from __future__ import annotations


def rows(df, *columns):
    """Sorted tuples of the given columns."""
    columns = columns or df.columns
    found = [tuple(r[c] for c in columns) for r in df.collect()]
    return sorted(found, key=lambda t: [(v is not None, str(v)) for v in t])


def one(df, condition):
    found = df.where(condition).collect()
    assert len(found) == 1, found
    return found[0]
