"""The calendar span a job works on, as a filter on the integer partition columns."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """A year, a month or a day. Filtering the table root prunes partitions, whether
    their folders are spelled ``month=5`` or ``month=05``."""

    year: int
    month: int | None = None
    day: int | None = None

    @classmethod
    def day_of(cls, date: dt.date) -> Period:
        return cls(date.year, date.month, date.day)

    @classmethod
    def month_of(cls, date: dt.date) -> Period:
        return cls(date.year, date.month)

    def holds(self, folder: str) -> bool:
        """A partition folder such as ``year=2024/month=05/day=08`` lies in the period, or
        may do so because it does not tell."""
        told = dict(level.split("=", 1) for level in folder.split("/"))
        wanted = {"year": self.year, "month": self.month, "day": self.day}
        return all(
            value is None or name not in told or told[name] in (str(value), f"{value:02d}")
            for name, value in wanted.items()
        )

    @staticmethod
    def may_begin_before(folder: str, date: dt.date) -> bool:
        """Rows of a daily or hourly partition folder may be older than a date."""
        told = dict(level.split("=", 1) for level in folder.split("/"))
        try:
            return dt.date(*[int(told[name]) for name in ("year", "month", "day")]) < date
        except ValueError:  # rows without a time
            return True

    def rows(self, df: DataFrame) -> DataFrame:
        condition = F.col("year") == self.year
        if self.month is not None:
            condition &= F.col("month") == self.month
        if self.day is not None:
            condition &= F.col("day") == self.day
        return df.where(condition)


def within(df: DataFrame, period: Period | None) -> DataFrame:
    """Rows of the period; all rows when there is none."""
    return df if period is None else period.rows(df)
