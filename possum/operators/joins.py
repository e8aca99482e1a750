"""Materialise once, measure, then broadcast or shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.session import checkpoint_dir

# A key set up to this many rows is broadcast (a few tens of MB of keys).
DEFAULT_BROADCAST_ROWS = 1_000_000


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once into the checkpoint folder and read it from there.

    Every later use sees the same rows, computed once, and a lost executor
    cannot change them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def at_most(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` (a stored result) has at most ``max_rows`` rows."""
    return df.count() <= max_rows


def measured_side(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``materialise`` then ``at_most``: the stored rows and whether they may be broadcast."""
    stored = materialise(df)
    return stored, at_most(stored, max_rows)


def maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df
