"""Prediction intervals, their width and coverage."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import buckets, rank_index, values_at
from ..functions.quantiles import cuts

RESIDUAL = "residual"


def _residuals(rows: DataFrame, label: str, prediction: str) -> DataFrame:
    return rows.withColumn(RESIDUAL, F.col(label) - F.col(prediction)) if label in rows.columns else rows.withColumn(RESIDUAL, F.lit(None).cast("double"))


def normal_intervals(rows: DataFrame, level: float = 0.95, label: str = "label", prediction: str = "prediction", calibration: DataFrame | None = None) -> DataFrame:
    """prediction -+ z * deviation of the calibration rows' residuals (by default the same rows); the lower end is at least 0.

    Without residuals the deviation is that of the predictions, or 1.0.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    known = _residuals(rows if calibration is None else calibration, label, prediction)
    spread = known.agg(F.coalesce(F.stddev_samp(RESIDUAL), F.stddev_samp(prediction), F.lit(1.0)).alias("_sd"))
    out = _residuals(rows, label, prediction).crossJoin(F.broadcast(spread))
    p = F.col(prediction)
    return with_width(out.withColumns({"lower_bound": F.greatest(p - z * F.col("_sd"), F.lit(0.0)), "upper_bound": p + z * F.col("_sd")}).drop("_sd"), prediction)


def quantile_intervals(rows: DataFrame, level: float = 0.95, label: str = "label", prediction: str = "prediction", calibration: DataFrame | None = None) -> DataFrame:
    """prediction plus the exact outer quantiles of the calibration rows' residuals; the lower end is at least 0."""
    known = _residuals(rows if calibration is None else calibration, label, prediction)
    out = _residuals(rows, label, prediction).crossJoin(F.broadcast(cuts(known, RESIDUAL, ((1 - level) / 2, (1 + level) / 2))))
    p = F.col(prediction)
    return with_width(out.withColumns({"lower_bound": F.greatest(p + F.col("q0"), F.lit(0.0)), "upper_bound": p + F.col("q1")}).drop("q0", "q1"), prediction)


def bootstrap_intervals(rows: DataFrame, keys: list[str], level: float = 0.95, resamples: int = 100, seed: int = 1, label: str = "label", prediction: str = "prediction", calibration: DataFrame | None = None) -> DataFrame:
    """prediction plus quantiles of ``resamples`` residuals that are drawn for each row, with replacement.

    Residuals are numbered in order of size, by an index of their distinct values. A row draws numbers by a hash of its key, the
    draw's number and the seed, so runs agree; as the k-th of the drawn residuals is the residual with the k-th of the drawn
    numbers, only two numbers of a row are looked up. Neither rows nor residuals pass through the driver or one task, also where
    most residuals are equal. A row without residuals has null bounds.
    """
    index = rank_index(_residuals(rows if calibration is None else calibration, label, prediction), RESIDUAL)
    at = lambda q: max(1, min(resamples, round(q * resamples + 0.5)))
    # Four draws of 32 bits in a digest. Their bytes sort as the numbers do, so only the draws that are looked up become numbers.
    texts = F.concat(F.lit(""), *[F.coalesce(F.concat(F.lit("|"), F.col(k).cast("string")), F.lit("")) for k in keys])
    digests = F.array(*[F.unhex(F.md5(F.concat(F.lit(f"{seed}|{i}"), F.col("_key")))) for i in range(1, -(-resamples // 4) + 1)])
    four = lambda d: F.array(*[F.substring(d, 4 * j + 1, 4) for j in range(4)])
    draws = F.sort_array(F.slice(F.flatten(F.transform(digests, four)), 1, resamples))
    out = _residuals(rows, label, prediction).crossJoin(F.broadcast(index.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_n")))).withColumn("_key", texts)
    # Each draw that is looked up is picked while the sorted ones are bound, so they are sorted once a row.
    ends = [at((1 - level) / 2), at((1 + level) / 2)]
    picked = F.transform(F.array(draws), lambda d: F.struct(*[F.conv(F.hex(F.element_at(d, k)), 16, 10).cast("long").alias(n) for k, n in zip(ends, ("lo", "hi"))]))[0]
    out = out.withColumn("_draws", picked)
    number = lambda k: F.floor(F.col(f"_draws.{k}") / F.lit(float(1 << 32)) * F.col("_n")).cast("long")
    out = out.withColumns({"_lo": number("lo"), "_hi": number("hi")}).drop("_draws", "_key", "_n")
    out = values_at(out, ["_lo", "_hi"], buckets(index))
    p = F.col(prediction)
    lower = F.when(F.col("_lo").isNotNull(), F.greatest(p + F.col("_lo"), F.lit(0.0)))
    out = out.withColumns({"lower_bound": lower, "upper_bound": p + F.col("_hi")}).drop("_lo", "_hi")
    return with_width(out, prediction)


def confidence(relative: Column) -> Column:
    return F.when(relative < 0.1, 1.0).when(relative < 0.3, 0.8).when(relative < 0.5, 0.6).when(relative < 0.8, 0.4).otherwise(0.2)


def with_width(rows: DataFrame, prediction: str = "prediction") -> DataFrame:
    """interval_width, relative_uncertainty (1.0 for predictions that are not positive) and confidence_score."""
    width, p = F.col("upper_bound") - F.col("lower_bound"), F.col(prediction)
    out = rows.withColumn("interval_width", width)
    out = out.withColumn("relative_uncertainty", F.when(p > 0, F.try_divide("interval_width", p)).otherwise(1.0))
    return out.withColumn("confidence_score", confidence(F.col("relative_uncertainty")))


def uncertainty_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(*[F.avg(c).alias(f"avg_{c}") for c in ("interval_width", "relative_uncertainty", "confidence_score")])


def coverage(rows: DataFrame, label: str = "label", level: float = 0.95, tolerance: float = 0.05) -> DataFrame:
    """One row: the share of labels inside, the mean width, and whether the share is near the level."""
    inside = F.col(label).between(F.col("lower_bound"), F.col("upper_bound"))
    out = rows.where(F.col(label).isNotNull()).agg(F.avg(F.when(inside, 1.0).otherwise(0.0)).alias("coverage"), F.avg("interval_width").alias("mean_width"))
    return out.withColumn("is_calibrated", F.abs(F.col("coverage") - level) < tolerance)
