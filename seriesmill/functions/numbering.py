"""Row numbers of a whole table in a given order, and what stands at a number, without bringing the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stored

#: ``monotonically_increasing_id`` counts within a partition below this bit.
PARTITION_BITS = 33
#: Numbers of a bucket, and buckets of a block.
WIDTH, BUCKETS = 256, 16


def _part(name: str) -> Column:
    return F.shiftright(F.col(name), PARTITION_BITS)


def _before(placed: DataFrame, name: str, rows: Column) -> DataFrame:
    """(_part, _start): the rows in the partitions before each, of which there is one number each."""
    sizes = placed.groupBy(_part(name).alias("_part")).agg(rows.alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))


def numbered(df: DataFrame, order: Sequence[Column | str], name: str, tasks: int | None = None) -> DataFrame:
    """``df`` with ``name``, 0 up to its rows less one in the given order, written once.

    A range sort puts the rows in order; a row's number is its place in its partition and the rows of the partitions before. With ``tasks``
    it has as many partitions, and rows that are equal in order are spread over them.
    """
    if tasks:
        tied = df.withColumn("_tie", F.monotonically_increasing_id())
        in_order = tied.repartitionByRange(tasks, *order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie")
    else:
        in_order = df.orderBy(*order)
    placed = stored(in_order.withColumn(name, F.monotonically_increasing_id()), "numbered")
    starts = _before(placed, name, F.count("*"))
    own = F.col(name).bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    return placed.join(F.broadcast(starts), _part(name) == F.col("_part")).withColumn(name, F.col("_start") + own).drop("_part", "_start")


def rank_index(df: DataFrame, column: str) -> DataFrame:
    """(x, rows, start): the distinct values of ``column`` that are not null, their rows, and the number of the first of these in order of value.

    Equal values are one row before anything is sorted, so a value that many rows share weighs no more than others; starts are running
    sums in each partition of the range sort, and the sums of the partitions before.
    """
    counted = df.select(F.col(column).alias("x")).where("x is not null").groupBy("x").agg(F.count("*").alias("rows"))
    placed = stored(counted.orderBy("x").withColumn("_at", F.monotonically_increasing_id()), "rank-index")
    starts = _before(placed, "_at", F.sum("rows"))
    here = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    own = placed.withColumn("_part", _part("_at")).withColumn("_up_to", F.sum("rows").over(here))
    return own.join(F.broadcast(starts), "_part").select("x", "rows", (F.col("_start") + F.col("_up_to") - F.col("rows")).alias("start"))


def buckets(index: DataFrame) -> DataFrame:
    """(block, bucket, at) of a rank index: for each WIDTH numbers the values that these reach, as an array of (start, x).

    A value of many numbers is in many buckets; it goes to their blocks first, which then make the buckets.
    """
    of_block = WIDTH * BUCKETS
    last = F.col("start") + F.col("rows") - 1
    spans = index.select("x", "start", last.alias("last"), F.explode(F.sequence(F.floor(F.col("start") / of_block), F.floor(last / of_block))).alias("block"))
    first = F.greatest(F.floor(F.col("start") / WIDTH), F.col("block") * BUCKETS)
    behind = F.least(F.floor(F.col("last") / WIDTH), F.col("block") * BUCKETS + BUCKETS - 1)
    pieces = spans.repartition("block").select("block", "start", "x", F.explode(F.sequence(first, behind)).alias("bucket"))
    return pieces.groupBy("block", "bucket").agg(F.array_sort(F.collect_list(F.struct("start", "x"))).alias("at"))


def values_at(rows: DataFrame, numbers: Sequence[str], table: DataFrame) -> DataFrame:
    """``rows`` with each of the columns ``numbers`` replaced by the value at that number, by a table of ``buckets``; null where there is none."""
    for name in numbers:
        bucket = F.floor(F.col(name) / WIDTH)
        found = rows.withColumns({"bucket": bucket, "block": F.floor(bucket / BUCKETS)}).join(table, ["block", "bucket"], "left")
        reached = F.filter("at", lambda s: s["start"] <= F.col(name))
        rows = found.withColumn(name, F.element_at(reached, -1)["x"]).drop("block", "bucket", "at")
    return rows
