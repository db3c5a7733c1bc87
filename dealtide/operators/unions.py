"""Union of many tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, in pairs: the plan stays shallow, however many tables there are."""
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = paired + (list(frames[-1:]) if len(frames) % 2 else [])
    return frames[0]
