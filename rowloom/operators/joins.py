"""Joins against reference data whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.session import BROADCAST_BYTES, BROADCAST_ROWS


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and ``size`` bytes, as JSON; it looks at no more than
    one row beyond."""
    width = F.sum(F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
    n, found = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(width, F.lit(0))).first()
    return n <= rows and found <= size


def join_dimension(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join facts to a dimension with unique keys.

    A dimension of at most ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` bytes is broadcast.  A larger one is joined by
    shuffle, where adaptive execution splits the partitions of hot keys.  Null keys match
    nothing.
    """
    if is_small(dim):
        return facts.join(F.broadcast(dim), on, how)
    return facts.join(dim, on, how)
