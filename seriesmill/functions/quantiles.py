"""Exact quantiles of a column by counted refinement."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import remove, stored_at

#: Cells of a histogram, and distinct values of a bracket that are ranked one by one.
CELLS, FEW = 65_536, 16_384


def position(x: Column, kind: T.DataType) -> Column:
    """A number that rises with ``x``."""
    if isinstance(kind, T.DateType):
        return F.unix_date(x)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(x.cast("timestamp"))
    return x


def spread(p: Column) -> Column:
    """A scale on which values of very different size lie apart."""
    return F.signum(p.cast("double")) * F.log1p(F.abs(p.cast("double")))


def cell(x: Column, distance: Column, width: Column) -> Column:
    """Which of CELLS cells of one width a value lies in, by its distance from the least one; infinite values and, last, NaN have their own."""
    d = x.cast("double")
    among = F.coalesce(F.floor(F.try_divide(distance, width) * CELLS), F.lit(0)).cast("long")
    return F.when(F.isnan(d), CELLS + 2).when(d == float("inf"), CELLS + 1).when(d == float("-inf"), -1).otherwise(among)


def apart(a: Column, b: Column) -> Column:
    """a - b, exact where their type can hold it."""
    return F.coalesce(F.try_subtract(a, b).cast("double"), a.cast("double") - b.cast("double"))


class Bracket:
    """Where some quantiles lie: between two values, ``before`` rows lie below; it holds so many distinct ``values``."""

    def __init__(self, lo, hi, before: int, values: int):
        self.lo, self.hi, self.before, self.values = lo, hi, before, values

    def holds(self, x: Column) -> Column:
        return (x >= F.lit(self.lo)) & (x <= F.lit(self.hi))


def histogram(counted: DataFrame, brackets: Sequence[Bracket | None], kind: T.DataType) -> DataFrame:
    """(bracket, cell, rows, lo, hi, values) of the values in each of the brackets, which don't overlap; None is the whole table."""
    x = F.col("x")
    p = position(x, kind)
    if list(brackets) == [None]:
        known = F.when(F.abs(p.cast("double")) < float("inf"), spread(p))
        ends = counted.agg(F.min(known).alias("a"), F.max(known).alias("b"))
        placed = counted.crossJoin(F.broadcast(ends)).withColumns({"bracket": F.lit(0), "cell": cell(p, spread(p) - F.col("a"), F.col("b") - F.col("a"))})
    else:
        which, at = F.lit(None).cast("int"), F.lit(None).cast("long")
        for k, b in enumerate(brackets):
            low, high = position(F.lit(b.lo), kind), position(F.lit(b.hi), kind)
            inside = cell(p, apart(p, low), apart(high, low))
            which, at = F.when(b.holds(x), k).otherwise(which), F.when(b.holds(x), inside).otherwise(at)
        placed = counted.select("x", "rows", which.alias("bracket"), at.alias("cell")).where("bracket is not null")
    return placed.groupBy("bracket", "cell").agg(F.sum("rows").alias("rows"), F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("values"))


def cuts(df: DataFrame, column: str, probabilities: Sequence[float], weight: str | None = None) -> DataFrame:
    """One row, q0, q1, ...: the exact discrete quantiles of ``column``, nulls left out. A row counts ``weight`` times.

    Runs jobs when it is called. Rows are counted by distinct value once, in a table that is removed in the end. A histogram of these
    counts says which cell each quantile lies in; the cell's least and greatest value are the next bracket, which is narrowed the
    same way until it holds FEW values, and those are ranked. The first histogram's cells grow with the values, so that a few very
    large ones leave the others apart. What comes to the driver is CELLS cells or FEW values for each quantile, for a table of any size.
    """
    spark, kind = df.sparkSession, df.schema[column].dataType
    values = df.select(F.col(column).alias("x"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("rows")).where("x is not null and rows > 0")
    counted, path = stored_at(values.groupBy("x").agg(F.sum("rows").alias("rows")), "counts")
    n, n_values = counted.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
    need = {p: max(1, -int(-round(p * n, 6) // 1)) for p in probabilities}
    held: dict[float, Bracket | None] = dict.fromkeys(probabilities)
    size = lambda b: n_values if b is None else b.values
    while wide := list(dict.fromkeys(b for b in held.values() if size(b) > FEW and (b is None or b.lo != b.hi))):
        cells = histogram(counted, wide, kind).toArrow().sort_by([("bracket", "ascending"), ("cell", "ascending")])
        bracket, rows = (cells.column(c).to_numpy() for c in ("bracket", "rows"))
        for k, b in enumerate(wide):
            first, behind = np.searchsorted(bracket, [k, k + 1])
            up_to = (b.before if b else 0) + np.cumsum(rows[first:behind])
            made: dict[int, Bracket] = {}
            for p in [p for p in held if held[p] is b]:
                at = int(np.searchsorted(up_to, need[p]))
                lo, hi, values_in = (cells.column(c)[first + at].as_py() for c in ("lo", "hi", "values"))
                made[at] = held[p] = made.get(at) or Bracket(lo, hi, int(up_to[at] - rows[first + at]), values_in)
    found = {}
    for b in dict.fromkeys(held.values()) if n else []:
        ranked = (counted.where(b.holds(F.col("x"))) if b else counted).repartition(1).sortWithinPartitions("x").toArrow()
        up_to = (b.before if b else 0) + np.cumsum(ranked.column("rows").to_numpy())
        for p in [p for p in held if held[p] is b]:
            found[p] = ranked.column("x")[int(np.searchsorted(up_to, need[p]))].as_py()
    remove(spark, path)
    schema = T.StructType([T.StructField(f"q{i}", kind) for i in range(len(probabilities))])
    return spark.createDataFrame([tuple(found.get(p) for p in probabilities)], schema)
