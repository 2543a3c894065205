"""Scalar and aggregate expressions with the null and error rules of the pipeline.

Spark 4 raises on a bad cast or a zero divisor. Feeds contain both, so numbers are
read with ``try_cast`` and every ratio is guarded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillhouse.schemas import UNKNOWN

# Largest epoch second whose microseconds fit a 64-bit timestamp.
MAX_EPOCH_SECOND = 9_223_372_036_854


def number(name: str, kind: str) -> Column:
    """Typed value of a column, null where the text is not such a number."""
    return F.col(name).try_cast(kind)


def whole_seconds(name: str) -> Column:
    """Epoch seconds as bigint; fractions are dropped, bad or absurd values are null."""
    seconds = number(name, "bigint")
    return F.when(seconds.between(-MAX_EPOCH_SECOND, MAX_EPOCH_SECOND), seconds)


def moment(name: str) -> Column:
    """Timestamp of an epoch-seconds column."""
    return F.timestamp_seconds(whole_seconds(name))


def calendar_parts(when: Column, hour: bool = True) -> dict[str, Column]:
    """Integer partition columns of a timestamp."""
    parts = {"year": F.year(when), "month": F.month(when), "day": F.dayofmonth(when)}
    return {**parts, "hour": F.hour(when)} if hour else parts


def upper_or_unknown(name: str) -> Column:
    return F.coalesce(F.upper(F.col(name)), F.lit(UNKNOWN))


def title_or_unknown(name: str) -> Column:
    return F.coalesce(F.initcap(F.col(name)), F.lit(UNKNOWN))


def sha256_hex(value: Column) -> Column:
    """Hex digest of the text form; null stays null."""
    return F.sha2(value.cast("string"), 256)


def salted_sha256_hex(value: Column, salt: str) -> Column:
    """Digest that cannot be looked up in a table of plain id hashes; null stays null."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def holds(condition: Column) -> Column:
    """The condition with null read as false."""
    return F.coalesce(condition, F.lit(False))


def share_of_rows(condition: Column) -> Column:
    """Fraction of rows for which the condition holds; null rows count as misses."""
    return F.avg(holds(condition).cast("int"))


def ratio(
    numerator: Column, denominator: Column, otherwise: float | None = 0.0, unit: int = 1
) -> Column:
    """Quotient for a positive denominator, ``otherwise`` in all other cases. In ``unit`` s
    of the numerator, which is one division, since two would round twice."""
    divisor = denominator if unit == 1 else denominator * unit
    return F.when(denominator > 0, numerator / divisor).otherwise(
        F.lit(otherwise).cast("double")
    )


def type_counts_json(entries: Column) -> Column:
    """JSON object text of an array of ``(type, count)`` structs, keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(entries)))
