"""What the tests ask of DataFrames."""

from __future__ import annotations


def rows(frame, *columns):
    """Rows of a frame as sorted tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
