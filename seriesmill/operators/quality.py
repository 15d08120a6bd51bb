"""Data-quality checks. A report is rows (check, metric, value, status): one pass with a window and one row of global figures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import cuts
from ..spec import PanelSpec


@dataclass(frozen=True)
class Limits:
    outlier_z: float = 3.0
    missing_rate: float = 0.05
    outlier_rate: float = 0.05
    gap_days: tuple[int, int] = (20, 45)


def status(bad: Column) -> Column:
    return F.when(bad, "WARNING").otherwise("PASS")


def is_missing(df: DataFrame, value: str) -> Column:
    c = F.col(value)
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[value] in ("double", "float") else c.isNull()


def missing(panel: DataFrame, spec: PanelSpec = PanelSpec(), limits: Limits = Limits()) -> DataFrame:
    out = panel.agg(F.count("*").alias("n_rows"), F.count_if(is_missing(panel, spec.value)).alias("n_missing"))
    rate = F.try_divide("n_missing", "n_rows")
    return out.withColumns({"missing_rate": rate, "status": status(rate > limits.missing_rate)})


def z_outliers(panel: DataFrame, spec: PanelSpec = PanelSpec(), limits: Limits = Limits(), by: str | None = None) -> DataFrame:
    """Rows further than ``outlier_z`` deviations from the mean: of the table, or of each group ``by``."""
    if by:
        own = Window.partitionBy(by)
        rows = panel.select(by, spec.value, F.avg(spec.v).over(own).alias("m"), F.stddev_samp(spec.v).over(own).alias("s"))
    else:
        rows = panel.select(spec.value).crossJoin(F.broadcast(panel.agg(F.avg(spec.v).alias("m"), F.stddev_samp(spec.v).alias("s"))))
    out = rows.agg(F.count(spec.v).alias("n_values"), F.count_if(F.abs(F.try_divide(spec.v - F.col("m"), F.col("s"))) > limits.outlier_z).alias("n_outliers"))
    rate = F.coalesce(F.try_divide("n_outliers", "n_values"), F.lit(0.0))
    return out.withColumns({"outlier_rate": rate, "status": status(rate >= limits.outlier_rate)})


def iqr_outliers(panel: DataFrame, spec: PanelSpec = PanelSpec(), reach: float = 1.5) -> DataFrame:
    """Rows outside the quartiles by more than ``reach`` of their distance; the rate is 0.0 when there are none."""
    rows = panel.select(spec.value).crossJoin(F.broadcast(cuts(panel, spec.value, (0.25, 0.75))))
    iqr = F.col("q1") - F.col("q0")
    out = rows.agg(
        F.count(spec.v).alias("n_values"),
        F.max("q0").alias("q1"),
        F.max("q1").alias("q3"),
        F.count_if((spec.v < F.col("q0") - reach * iqr) | (spec.v > F.col("q1") + reach * iqr)).alias("n_outliers"),
    )
    return out.withColumn("iqr_rate", F.coalesce(F.try_divide("n_outliers", "n_values"), F.lit(0.0)))


def time_gaps(panel: DataFrame, spec: PanelSpec = PanelSpec(), limits: Limits = Limits()) -> DataFrame:
    """Steps between rows of a series that are too long or too short, in days."""
    days = panel.select(F.datediff(spec.d, F.lag(spec.date).over(spec.w)).alias("days"))
    low, high = limits.gap_days
    out = days.agg(F.count("days").alias("n_steps"), F.count_if((F.col("days") > high) | (F.col("days") < low)).alias("n_gaps"))
    rate = F.coalesce(F.try_divide("n_gaps", "n_steps"), F.lit(0.0))
    return out.withColumns({"gap_rate": rate, "status": status(F.col("n_gaps") > 0)})


def demand_type(zero_rate: Column) -> Column:
    return F.when(zero_rate < 0.1, "Regular").when(zero_rate < 0.3, "Intermittent").when(zero_rate < 0.5, "Sporadic").otherwise("Very Sparse")


def zero_pattern(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Zeros, their rate among all rows, pairs of zeros in a row within a series, and the demand type."""
    rows = panel.select(spec.value, F.lag(spec.value).over(spec.w).alias("before"))
    out = rows.agg(F.count("*").alias("n_rows"), F.count_if(spec.v == 0).alias("n_zeros"), F.count_if((spec.v == 0) & (F.col("before") == 0)).alias("n_zero_pairs"))
    rate = F.try_divide("n_zeros", "n_rows")
    return out.withColumns({"zero_rate": rate, "demand_type": demand_type(rate)})


def statistics(panel: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    out = panel.agg(F.count(v).alias("n_values"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("stddev"), F.min(v).alias("min"), F.max(v).alias("max"))
    return out.withColumn("cv", F.try_divide("stddev", "mean"))


def seasonality(panel: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """1 less the share of variance within calendar months, at least 0, and its grade. Sums by month give both variances."""
    months = panel.groupBy(F.month(spec.d).alias("m")).agg(F.var_samp(spec.v).alias("within"))
    total = panel.agg(F.var_samp(spec.v).alias("total_variance"))
    out = months.agg(F.avg("within").alias("within_variance")).crossJoin(F.broadcast(total))
    strength = F.greatest(F.lit(0.0), 1 - F.try_divide("within_variance", "total_variance"))
    s = F.col("strength")
    grade = F.when(s > 0.4, "Strong").when(s > 0.2, "Moderate").when(s > 0.05, "Weak").otherwise("None")
    return out.withColumn("strength", strength).withColumn("grade", grade)


def report(panel: DataFrame, spec: PanelSpec = PanelSpec(), limits: Limits = Limits()) -> DataFrame:
    """All checks as rows (check, metric, value, status); checks without a verdict of their own have a null status.

    One pass with a window gives all sums; outliers take a second one, with the mean, deviation and quartiles at hand.
    """
    v, low, high = spec.v, *limits.gap_days
    rows = panel.select(spec.value, is_missing(panel, spec.value).alias("_missing"), F.month(spec.d).alias("_month"), F.lag(spec.value).over(spec.w).alias("_before"), F.datediff(spec.d, F.lag(spec.date).over(spec.w)).alias("_days"))
    sums = rows.agg(
        F.count("*").alias("n"), F.count_if("_missing").alias("missing"), F.count(v).alias("known"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"), F.var_samp(v).alias("variance"),
        F.count_if(v == 0).alias("zeros"), F.count("_days").alias("steps"), F.count_if((F.col("_days") > high) | (F.col("_days") < low)).alias("gaps"),
        F.array_compact(F.array(*[F.var_samp(F.when(F.col("_month") == m, v)) for m in range(1, 13)])).alias("within"),
    )
    known = sums.crossJoin(F.broadcast(cuts(panel, spec.value, (0.25, 0.75))))
    iqr = F.col("q1") - F.col("q0")
    outer = panel.select(spec.value).crossJoin(F.broadcast(known)).agg(
        F.count_if(F.abs(F.try_divide(v - F.col("mean"), F.col("sd"))) > limits.outlier_z).alias("far"),
        F.count_if((v < F.col("q0") - 1.5 * iqr) | (v > F.col("q1") + 1.5 * iqr)).alias("outside"),
    )
    within = F.aggregate("within", F.lit(0.0), lambda s, x: s + x)
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    none = F.lit(None).cast("string")
    missing_, far, gaps = F.try_divide("missing", "n"), rate("far", "known"), rate("gaps", "steps")
    checks = [
        ("missing", "missing_rate", missing_, status(missing_ > limits.missing_rate)),
        ("outliers", "outlier_rate", far, status(far >= limits.outlier_rate)),
        ("iqr", "iqr_rate", rate("outside", "known"), none),
        ("gaps", "gap_rate", gaps, status(F.col("gaps") > 0)),
        ("zeros", "zero_rate", F.try_divide("zeros", "n"), none),
        ("statistics", "cv", F.try_divide("sd", "mean"), none),
        ("seasonality", "strength", F.greatest(F.lit(0.0), 1 - F.try_divide(F.try_divide(within, F.size("within")), F.col("variance"))), none),
    ]
    found = F.array(*[F.struct(F.lit(c).alias("check"), F.lit(m).alias("metric"), x.cast("double").alias("value"), st.alias("status")) for c, m, x, st in checks])
    return sums.crossJoin(F.broadcast(outer)).select(F.inline(found))


def overall(report: DataFrame) -> DataFrame:
    """One row: WARNING if any check warns, else PASS if any passes, else UNKNOWN."""
    any_is = lambda s: F.coalesce(F.bool_or(F.col("status") == s), F.lit(False))
    return report.agg(F.when(any_is("WARNING"), "WARNING").when(any_is("PASS"), "PASS").otherwise("UNKNOWN").alias("overall_status"))


ADVICE = (
    ("missing", lambda v: v > 0.05, "Impute missing values before fitting"),
    ("outliers", lambda v: v >= 0.05, "Treat outliers or use robust models"),
    ("gaps", lambda v: v > 0, "Fill gaps between dates"),
    ("zeros", lambda v: v > 0.3, "Use models for intermittent demand"),
    ("seasonality", lambda v: v > 0.2, "Add seasonal features"),
)


def recommendations(report: DataFrame) -> DataFrame:
    """(check, recommendation) for each check whose value calls for something."""
    said = F.lit(None).cast("string")
    for check, rule, text in ADVICE:
        said = F.when((F.col("check") == check) & rule(F.col("value")), text).otherwise(said)
    return report.withColumn("recommendation", said).where("recommendation is not null").select("check", "recommendation")


def drift(train: DataFrame, test: DataFrame, value: str, limit: float = 0.3) -> DataFrame:
    """Relative change of mean and deviation from train to test, in one pass over both."""
    both = train.select(F.col(value).alias("x"), F.lit(True).alias("old")).union(test.select(F.col(value), F.lit(False)))
    of = lambda f, old: f(F.when(F.col("old") == old, F.col("x")))
    sums = both.agg(of(F.avg, True).alias("train_mean"), of(F.avg, False).alias("test_mean"), of(F.stddev_samp, True).alias("train_std"), of(F.stddev_samp, False).alias("test_std"))
    rel = lambda s: F.try_divide(F.abs(F.col(f"test_{s}") - F.col(f"train_{s}")), F.abs(f"train_{s}"))
    out = sums.withColumns({"mean_change": rel("mean"), "std_change": rel("std")})
    return out.withColumn("status", status((F.col("mean_change") > limit) | (F.col("std_change") > limit)))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, n_null, null_percent) of every column, from one aggregate."""
    counts = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = counts.unpivot(["_n"], df.columns, "column", "n_null")
    return long.select("column", "n_null", (100 * F.try_divide("n_null", "_n")).alias("null_percent"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, r) for all pairs of columns, from one aggregate over all rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(F.col(a), F.col(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{i}").alias("r")) for i, (a, b) in enumerate(pairs)])))


def profile(daily: DataFrame, product: str, date: str, quantity: str) -> DataFrame:
    q = F.col(quantity)
    return daily.agg(
        F.count(q).alias("n_rows"), F.avg(q).alias("mean"), F.stddev_samp(q).alias("stddev"), F.min(q).alias("min"), F.max(q).alias("max"),
        F.countDistinct(product).alias("n_items"), F.min(date).alias("first_date"), F.max(date).alias("last_date"),
    )
