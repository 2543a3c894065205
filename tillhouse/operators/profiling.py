"""Data quality figures of a raw feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.columns import number


def profile(df: DataFrame, expected: T.StructType, keys: Sequence[str]) -> DataFrame:
    """One row per column: nulls and values that are not of the expected type, plus the
    row count and the number of surplus copies of a key.

    The copies come from one count per key, which Spark builds up inside the map tasks;
    the column figures are sums on top of it, so the feed is read and shuffled once and
    only the per-key counts travel.
    """
    figures = []
    for field in expected:
        value = F.col(field.name)
        bad = value.isNotNull() & number(field.name, field.dataType.simpleString()).isNull()
        figures += [
            F.count_if(value.isNull()).alias(f"{field.name}__nulls"),
            F.count_if(bad).alias(f"{field.name}__mismatches"),
        ]
    per_key = df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        F.count("*").alias("_copies"), *figures
    )
    names = [f.name for f in expected]
    totals = per_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("surplus_copies"),
        *[
            F.struct(
                F.lit(n).alias("column_name"),
                F.coalesce(F.sum(f"{n}__nulls"), F.lit(0)).alias("nulls"),
                F.coalesce(F.sum(f"{n}__mismatches"), F.lit(0)).alias("type_mismatches"),
            ).alias(n)
            for n in names
        ],
    )
    return totals.select(
        F.inline(F.array(*names)), "row_count", "surplus_copies"
    ).select("column_name", "nulls", "type_mismatches", "row_count", "surplus_copies")


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Audit line per stage: its name and row count, as one frame.

    Counting stored tables reads only file footers. Observed metrics of a running job
    are no substitute: a map stage that is repeated after a lost executor adds to them
    twice.
    """
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, df in stages.items()
    ]
    audit = counts[0]
    for line in counts[1:]:
        audit = audit.unionAll(line)
    return audit
