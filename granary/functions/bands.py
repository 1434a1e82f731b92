"""Scores and labels from thresholds."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _band(value: Column, bands: Sequence[tuple[float, Any]], default: Any, closed: bool) -> Column:
    result = F.lit(default)
    for limit, outcome in sorted(bands, key=lambda band: band[0]):
        reached = value >= limit if closed else value > limit
        result = F.when(reached, F.lit(outcome)).otherwise(result)
    return result


def score_by_threshold(value: Column, bands: Sequence[tuple[float, int]], default: int) -> Column:
    """Score of the highest threshold strictly exceeded; ``default`` else and for NULL."""
    return _band(value, bands, default, closed=False)


def label_by_threshold(value: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """Label of the highest threshold reached; ``default`` else and for NULL."""
    return _band(value, bands, default, closed=True)
