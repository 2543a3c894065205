"""Row checks: the accepted rows, and the rejected ones with a reason."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.columns import holds

REASON = "reject_reason"


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail early, letter case aside, when an input lacks a column."""
    present = {c.lower() for c in df.columns}
    missing = [n for n in names if n.lower() not in present]
    if missing:
        raise ValueError(f"input lacks required column(s): {', '.join(missing)}")
    return df


def passing(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows for which every check is true; a null check drops the row."""
    return df.where(reduce(lambda a, b: a & b, checks.values())) if checks else df


def failing(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Exact complement of ``passing``, with the name of the first failed check."""
    if not checks:
        return df.withColumn(REASON, F.lit(None).cast("string")).where(F.lit(False))
    reasons = [F.when(~holds(check), F.lit(name)) for name, check in checks.items()]
    return df.withColumn(REASON, F.coalesce(*reasons)).where(F.col(REASON).isNotNull())


def with_complete_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a key comparison can match; the others would be inserted again on each run."""
    return df.na.drop(subset=list(keys))


def with_broken_key(df: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """Rows for quarantine: some part of the key is null."""
    broken = reduce(lambda a, b: a | b, [key.isNull() for key in keys])
    return df.where(broken).withColumn(REASON, F.lit("null_key"))
