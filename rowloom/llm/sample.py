"""Bounded samples for training."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = 1 << 40


def hash_share(key: str, share: Column | float, seed: int) -> Column:
    """Whether the hash of a key falls into a share of its range.

    Every run and every partitioning chooses the same rows, nothing is sorted, and a task
    sends on only what it keeps."""
    bound = share if isinstance(share, Column) else F.lit(share)
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_RANGE)) < bound * _RANGE
