"""Union of many small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of ``frames``, matched by column name. Pairing them up keeps each intermediate plan,
    which Spark analyses anew at every step, small."""
    level = list(frames)
    while len(level) > 1:
        odd = level[len(level) - len(level) % 2 :]
        level = [a.unionByName(b) for a, b in zip(level[::2], level[1::2])] + odd
    return level[0]
