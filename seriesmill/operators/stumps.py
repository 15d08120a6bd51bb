"""Exact best splits: trees of one split, by running sums over each feature's sorted values, for features with any number of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbering import PARTITION_BITS
from ..sources.tables import stored


def best_splits(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, cut, left_mean, right_mean, n, gain, share): the split of each feature that leaves the least squared error, over rows that have feature and label.

    Values up to ``cut``, half-way between two of the feature's values, go left. ``gain`` is the drop in the sum of squared errors and
    ``share`` its part of that sum: how much of the label one split of this feature explains. The least cut wins ties;
    features of one value have no split. Rows are summed by value, and values are sorted by range over all features, so
    sums run in each partition, on top of those of the partitions before: a number for each partition and feature.
    """
    centre = rows.agg(F.avg(F.col(label).cast("double")).alias("centre"))
    y = F.col(label).cast("double") - F.col("centre")
    known = rows.select(label, *features).crossJoin(F.broadcast(centre)).where(F.col(label).isNotNull())
    long = known.select(y.alias("y"), "centre", F.inline(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features]))).where("v is not null")
    values = long.groupBy("feature", "v", "centre").agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
    placed = stored(values.orderBy("feature", "v").withColumn("part", F.shiftright(F.monotonically_increasing_id(), PARTITION_BITS)), "split-values")
    parts = placed.groupBy("feature", "part").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.min("v").alias("first"))
    order, whole = Window.partitionBy("feature").orderBy("part"), Window.partitionBy("feature")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in "ns"]
    parts = parts.select("feature", "part", *before, *[F.sum(c).over(whole).alias(f"{c}_all") for c in "nsq"], F.lead("first").over(order).alias("next_first"))
    here = Window.partitionBy("feature", "part").orderBy("v")
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    run = placed.withColumns({"n_here": F.sum("n").over(up_to), "s_here": F.sum("s").over(up_to), "next": F.lead("v").over(here)}).join(F.broadcast(parts), ["feature", "part"])
    n, s = F.col("n_before") + F.col("n_here"), F.col("s_before") + F.col("s_here")
    m, t = F.col("n_all") - n, F.col("s_all") - s
    gain = s * s / n + t * t / m - F.col("s_all") * F.col("s_all") / F.col("n_all")
    following = F.coalesce("next", "next_first")
    split = run.where(following.isNotNull()).select(
        "feature", ((F.col("v") + following) / 2).alias("cut"), (F.col("centre") + s / n).alias("left_mean"), (F.col("centre") + t / m).alias("right_mean"),
        F.col("n_all").alias("n"), gain.alias("gain"), F.try_divide(gain, F.col("q_all") - F.col("s_all") * F.col("s_all") / F.col("n_all")).alias("share"),
    )
    best = split.groupBy("feature").agg(F.max_by(F.struct("cut", "left_mean", "right_mean", "n", "gain", "share"), F.struct("gain", -F.col("cut"))).alias("best"))
    return best.select("feature", "best.*")


def importances(rows: DataFrame, features: Sequence[str], label: str, model: str) -> DataFrame:
    """(feature, model, importance): the share of the label's variance that one split of each feature explains."""
    return best_splits(rows, features, label).select("feature", F.lit(model).alias("model"), F.col("share").alias("importance"))
