"""Upsert as a relational expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def merge_frames(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take all columns of the update, unmatched updates are added.

    ``updates`` holds one row per key and no null key. The anti join moves only the
    keys of the updates to the table side, and a skewed table side is split by AQE.
    """
    untouched = existing.join(updates.select(*keys), list(keys), "left_anti")
    return untouched.select(*existing.columns).unionByName(updates)
