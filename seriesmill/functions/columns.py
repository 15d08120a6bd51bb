"""Scalar expressions, and a hint for joins; division by zero gives null, never an error (Spark 4 is ANSI by default)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_large(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that has rows by series: Spark judges written tables by their bytes, and many equal values take few, so it must not broadcast them."""
    return df.hint("merge")


#: Rows of a task that works along series or sorts rows.
SERIES_ROWS = 500_000


def tasks_of(spark: SparkSession, rows: int) -> int:
    """How many tasks read ``rows`` rows, SERIES_ROWS each at most, but one a core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // SERIES_ROWS))


def by_series(df: DataFrame, rows: int, key: str = "product") -> DataFrame:
    """``df``, of ``rows`` rows, dealt by series to as many tasks as its rows need: by their bytes, of which equal values take few, Spark would join
    partitions to tasks whose memory grows with the table. Windows and groups by series need no further shuffle."""
    return df.repartition(tasks_of(df.sparkSession, rows), key)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is null or zero."""
    return F.try_divide(a, b)


def change(now: Column, before: Column) -> Column:
    """Relative change, null where ``before`` is null or zero."""
    return F.try_divide(now - before, before)


def sign_of(x: Column) -> Column:
    """1, -1 or 0; null counts as 0."""
    return F.when(x > 0, 1).when(x < 0, -1).otherwise(0)


def percent(alpha: float) -> int:
    """The suffix of a column named for a share: 0.29 is 29."""
    return round(alpha * 100)


def rounded(columns: Iterable[str], digits: int = 6) -> list[Column]:
    return [F.round(c, digits).alias(c) for c in columns]


def rounded_doubles(columns: Iterable[str], digits: int = 6) -> list[Column]:
    """As ``rounded``, of doubles: whole ones stay as they are, as rounding goes by way of their decimal digits and takes longest. Zero loses its sign in both."""
    return [F.when(F.col(c) == F.floor(c), F.col(c) + F.lit(0.0)).otherwise(F.round(c, digits)).alias(c) for c in columns]


def months_apart(later: Column, earlier: Column) -> Column:
    """Whole months between two month ends."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def category_of(cov: Column, interval: Column, cov_cut: float = 0.8, interval_cut: float = 1.5) -> Column:
    """Demand class by the variation of positive months and the mean interval between them; nulls are Lumpy."""
    steady, frequent = cov <= cov_cut, interval <= interval_cut
    return (
        F.when(steady & frequent, "Smooth").when((cov > cov_cut) & frequent, "Erratic").when(steady & (interval > interval_cut), "Intermittent").otherwise("Lumpy")
    )


CATEGORIES = ("Smooth", "Erratic", "Intermittent", "Lumpy")
