"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_newest(df: DataFrame, keys: Sequence[str], recency: str | None = None) -> DataFrame:
    """Keep for each key the row with the greatest ``recency``, then the greatest
    value of each other column in table order (null is the smallest value).

    Null key values form one group, as in ``dropDuplicates``. The row is picked by an
    aggregate, so copies collapse inside each map task: a key that owns a third of
    the table costs the reducer one row per map task.
    """
    lowered = {k.lower() for k in keys}
    others = [c for c in df.columns if c.lower() not in lowered]
    ranked = sorted(others, key=lambda c: c != recency)
    if not ranked:
        return df.select(*keys).distinct()
    packed = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_survivor"))
    return packed.select(*[c if c.lower() in lowered else f"_survivor.{c}" for c in df.columns])

