"""From order lines to complete monthly series with their base features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import by_series, category_of, months_apart, ratio
from ..functions.quantiles import cuts
from ..spec import PanelSpec

MONTHLY = PanelSpec()


def clean_lines(lines: DataFrame, key: str, quantity: str, *, excluded_key: str | None = None, equal: dict[str, str] | None = None, differ: dict[str, str] | None = None, present: Sequence[str] = ()) -> DataFrame:
    """Lines worth counting. Conditions are three-valued: a null key, currency or order type drops the line."""
    kept = F.col(quantity) > 0
    if excluded_key:
        kept &= ~F.col(key).like(excluded_key)
    for name, value in (equal or {}).items():
        kept &= F.col(name) == value
    for name, value in (differ or {}).items():
        kept &= F.col(name) != value
    for name in present:
        kept &= F.col(name).isNotNull()
    return lines.where(kept)


def decimals_to_double(df: DataFrame) -> DataFrame:
    """Every decimal column as double, in one projection."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name) for f in df.schema])


def monthly_rollup(daily: DataFrame, product: str, date: str, quantity: str) -> DataFrame:
    """(product, month_end, quantity, min_date, max_date): sums by month; the bounds are windows over the few monthly rows."""
    months = daily.groupBy(F.col(product).alias("product"), F.last_day(F.col(date).cast("date")).alias("month_end")).agg(F.sum(quantity).alias("quantity"))
    whole = MONTHLY.whole
    return months.withColumns({"min_date": F.min("month_end").over(whole), "max_date": F.max("month_end").over(whole)})


def complete_months(monthly: DataFrame, spec: PanelSpec = MONTHLY, fill: float | None = 0.0) -> DataFrame:
    """Every month from a series' first to its last; missing ones hold ``fill``.

    Each row is followed by the months up to the next row's: no grid is joined. Months are stepped by their first day, so
    that month ends of any length are met.
    """
    first = F.trunc(spec.d, "month")
    following = F.coalesce(F.add_months(F.trunc(F.lead(spec.date).over(spec.w), "month"), -1), first)
    rows = monthly.select(spec.product, spec.value, first.alias("first"), following.alias("last"))
    months = rows.select(spec.product, spec.value, "first", F.explode(F.expr("sequence(first, last, interval 1 month)")).alias("month"))
    value = F.when(F.col("month") == F.col("first"), spec.v)
    return months.select(spec.product, F.last_day("month").alias(spec.date), (value if fill is None else F.coalesce(value, F.lit(fill))).alias(spec.value))


def class_statistics(panel: DataFrame, spec: PanelSpec = MONTHLY, as_of: Column | None = None) -> DataFrame:
    """``panel`` with total_orders, cov_quantity, avg_demand_interval and product_category of its series.

    ``as_of`` limits the rows that the statistics look at; they hold for all rows of the series, so that later rows carry a
    class which was known at the cut.
    """
    return _classed(panel.withColumn("_gap", _gap(spec, as_of)), spec, as_of)


def _classed(panel: DataFrame, spec: PanelSpec, as_of: Column | None) -> DataFrame:
    """Rows with _gap, which goes, and the statistics of their series and its class."""
    out = panel.withColumns(_class_columns(spec, as_of))
    return out.withColumn("product_category", category_of(F.col("cov_quantity"), F.col("avg_demand_interval"))).drop("_gap")


def _seen(spec: PanelSpec, as_of: Column | None) -> Column:
    return (spec.v > 0) if as_of is None else (spec.v > 0) & (spec.d <= as_of)


def _gap(spec: PanelSpec, as_of: Column | None) -> Column:
    """The months from a positive month back to the one before it."""
    seen, before = _seen(spec, as_of), spec.w.rowsBetween(Window.unboundedPreceding, -1)
    return F.when(seen, months_apart(spec.d, F.last(F.when(seen, spec.d), True).over(before)))


def _class_columns(spec: PanelSpec, as_of: Column | None) -> dict[str, Column]:
    """Statistics of whole series, of rows with _gap."""
    seen = _seen(spec, as_of)
    sold = F.when(seen, spec.v)
    return {
        "total_orders": F.count_if(seen).over(spec.whole),
        "cov_quantity": ratio(F.stddev_samp(sold).over(spec.whole), F.avg(sold).over(spec.whole)),
        "avg_demand_interval": F.avg("_gap").over(spec.whole),
    }


def class_table(panel: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    """One row per series with its class statistics."""
    before = spec.w.rowsBetween(Window.unboundedPreceding, -1)
    sold = F.when(spec.v > 0, spec.v)
    gap = F.when(spec.v > 0, months_apart(spec.d, F.last(F.when(spec.v > 0, spec.d), True).over(before)))
    table = panel.select(spec.product, sold.alias("sold"), gap.alias("gap")).groupBy(spec.product)
    table = table.agg(F.count("sold").alias("total_orders"), ratio(F.stddev_samp("sold"), F.avg("sold")).alias("cov_quantity"), F.avg("gap").alias("avg_demand_interval"))
    return table.withColumn("product_category", category_of(F.col("cov_quantity"), F.col("avg_demand_interval")))


def _calendar(spec: PanelSpec) -> dict[str, Column]:
    return {"month": F.month(spec.d).cast("float"), "year": F.year(spec.d).cast("float")}


def calendar(panel: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    return panel.withColumns(_calendar(spec))


def _recency(spec: PanelSpec) -> dict[str, Column]:
    last = lambda x: F.last(F.when(spec.v > 0, x), True).over(spec.so_far)
    return {"months_since_last_order": months_apart(spec.d, last(spec.d)).cast("double"), "last_order_quantity": last(spec.v)}


def recency(panel: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    """months_since_last_order (0 on positive months, null before the first) and last_order_quantity."""
    return panel.withColumns(_recency(spec))


def _lags(spec: PanelSpec, steps: Sequence[int] = (1, 2, 3, 4, 5), lead: int | None = 1) -> dict[str, Column]:
    out = {f"lag_{n}": F.lag(spec.value, n).over(spec.w) for n in steps}
    return out | ({f"lead_month_{lead}": F.lead(spec.value, lead).over(spec.w)} if lead else {})


def lags(panel: DataFrame, spec: PanelSpec = MONTHLY, steps: Sequence[int] = (1, 2, 3, 4, 5), lead: int | None = 1) -> DataFrame:
    return panel.withColumns(_lags(spec, steps, lead))


MONTHS, SALES = (4, 8, 12), (3, 5, 7)


def _month_means(spec: PanelSpec, months: Sequence[int] = MONTHS) -> dict[str, Column]:
    return {f"ma_{n}_month": F.avg(spec.v).over(spec.last_rows(n)) for n in months}


def _earlier_sales(spec: PanelSpec, sales: Sequence[int] = SALES) -> dict[str, Column]:
    """_sold_k: the k-th positive value before each row."""
    return {f"_sold_{k}": F.expr(f"lag(case when `{spec.value}` > 0 then `{spec.value}` end, {k}) ignore nulls").over(spec.w) for k in range(1, max(sales) + 1)}


def _sale_means(spec: PanelSpec, sales: Sequence[int] = SALES) -> dict[str, Column]:
    """ma_n_sales, of rows with _earlier_sales; values are added from the earliest on."""
    none, before = F.lit(0).cast("long"), [F.col(f"_sold_{k}") for k in range(1, max(sales) + 1)]

    def mean(values: Sequence[Column]) -> Column:
        total, n = none, F.lit(0)
        for x in reversed(values):
            total, n = total + F.coalesce(x, none), n + x.isNotNull().cast("int")
        return F.try_divide(total, n)

    return {f"ma_{n}_sales": F.when(spec.v > 0, mean([spec.v, *before[: n - 1]])).otherwise(mean(before[:n])) for n in sales}


def moving_averages(panel: DataFrame, spec: PanelSpec = MONTHLY, months: Sequence[int] = MONTHS, sales: Sequence[int] = SALES) -> DataFrame:
    """ma_n_month over the last n rows; ma_n_sales over the last n positive months, carried over the months without sales.

    Positive months are looked up behind each row, whatever lies between them, in the same order as all other windows of a series.
    """
    if not sales:
        return panel.withColumns(_month_means(spec, months))
    earlier = _earlier_sales(spec, sales)
    return panel.withColumns(_month_means(spec, months) | earlier).withColumns(_sale_means(spec, sales)).drop(*earlier)


def _mean_of_few(spec: PanelSpec, n: int) -> Column:
    """The mean of the last ``n`` rows as a double. They are looked up one by one and added from the earliest on, which costs less than a frame that slides over few rows."""
    total, rows = F.lit(0.0), F.lit(0)
    for x in [*(F.lag(spec.value, k).over(spec.w) for k in range(n - 1, 0, -1)), spec.v]:
        total, rows = total + F.coalesce(x.cast("double"), F.lit(0.0)), rows + x.isNotNull().cast("int")
    return F.try_divide(total, rows)


def model_features(panel: DataFrame, spec: PanelSpec = MONTHLY, steps: Sequence[int] = (1, 2), months: int = 4, as_of: Column | None = None) -> DataFrame:
    """Calendar, lags, target, the mean of the last few months and the class of a series: one window along it and one of it whole."""
    along = _calendar(spec) | _lags(spec, steps) | {f"ma_{months}_month": _mean_of_few(spec, months), "_gap": _gap(spec, as_of)}
    return _classed(panel.withColumns(along), spec, as_of)


def series_means(monthly: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    """(avg_demand_quantity, rows) of each series once its months are complete, from the months it has: the others count 0."""
    rows = months_apart(F.max(spec.date), F.min(spec.date)) + 1
    return monthly.groupBy(spec.product).agg((F.sum(spec.v) / rows).alias("avg_demand_quantity"), rows.alias("rows"))


def demand_buckets(panel: DataFrame, spec: PanelSpec = MONTHLY, per_product: bool = False, series: DataFrame | None = None) -> DataFrame:
    """avg_demand_quantity of the series and its decile bucket, B1 to B10.

    Deciles are over panel rows, so long series weigh more; ``per_product`` counts each series once. One row per series with its
    number of rows says as much as all rows: ``series`` may bring them from where they are cheaper to have.
    """
    out = panel.withColumns(_series_mean(spec))
    if series is None:
        series = panel.groupBy(spec.product).agg((F.sum(spec.v) / F.count("*")).alias("avg_demand_quantity"), F.count("*").alias("rows"))
    return _bucketed(out, series, per_product)


def _series_mean(spec: PanelSpec) -> dict[str, Column]:
    return {"avg_demand_quantity": F.sum(spec.v).over(spec.whole) / F.count("*").over(spec.whole)}


def _bucketed(out: DataFrame, series: DataFrame, per_product: bool = False) -> DataFrame:
    """Rows with avg_demand_quantity, and bucket by the deciles of ``series``."""
    deciles = cuts(series, "avg_demand_quantity", [k / 10 for k in range(1, 10)], weight=None if per_product else "rows")
    bucket = F.when(F.col("avg_demand_quantity") <= F.col("q0"), "B1")
    for k in range(1, 9):
        bucket = bucket.when(F.col("avg_demand_quantity") <= F.col(f"q{k}"), f"B{k + 1}")
    return out.crossJoin(F.broadcast(deciles)).withColumn("bucket", bucket.otherwise("B10")).drop(*[f"q{k}" for k in range(9)])


def add_features(monthly: DataFrame, spec: PanelSpec = MONTHLY, as_of: Column | None = None) -> DataFrame:
    """The complete feature panel: gap filling, calendar, recency, lags, target, class, moving averages and buckets.

    All columns along a series are one window, all of whole series another. ``monthly`` is read three times (its rows are counted and its
    deciles found when this is called), so a written table is cheaper.
    """
    rows = by_series(monthly.select(spec.product, spec.date, spec.value), monthly.count(), spec.product)
    earlier = _earlier_sales(spec)
    out = complete_months(rows, spec).withColumns({**_calendar(spec), **_recency(spec), **_lags(spec), **_month_means(spec), **earlier, "_gap": _gap(spec, as_of)})
    out = out.withColumns(_class_columns(spec, as_of) | _series_mean(spec))
    out = out.withColumns({"product_category": category_of(F.col("cov_quantity"), F.col("avg_demand_interval")), **_sale_means(spec)}).drop("_gap", *earlier)
    return _bucketed(out, series_means(monthly, spec))


def long_enough(panel: DataFrame, least: int = 5) -> DataFrame:
    return panel.where(F.col("total_orders") >= least)


def model_rows(panel: DataFrame, category: str, columns: Sequence[str]) -> DataFrame:
    """Rows of one class without nulls in the columns that are used."""
    return panel.where(F.col("product_category") == category).na.drop("any", subset=list(columns))


def latest_month(panel: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    """Rows of the last month of all; series that end before have none. The maximum is a broadcast row of the plan."""
    return panel.join(F.broadcast(panel.agg(F.max(spec.date).alias(spec.date))), spec.date, "left_semi")


def category_profile(classes: DataFrame, mean_demand: str | None = None) -> DataFrame:
    """Series by class with mean variation and interval, most frequent first."""
    more = [F.avg(mean_demand).alias("mean_demand")] if mean_demand else []
    profile = classes.groupBy("product_category").agg(F.count("*").alias("n_series"), *more, F.avg("cov_quantity").alias("mean_cov"), F.avg("avg_demand_interval").alias("mean_interval"))
    return profile.orderBy(F.desc("n_series"), "product_category")


def zero_profile(panel: DataFrame, spec: PanelSpec = MONTHLY) -> DataFrame:
    total, zero = F.count("*"), F.count_if(spec.v == 0)
    return panel.groupBy(spec.product).agg(total.alias("total_months"), zero.alias("zero_months"), (zero / total).alias("zero_rate"))


def pivot_days(long: DataFrame, key: str, number: str, value: str, prefix: str = "d_") -> DataFrame:
    """(key, d_1, d_2, ...): sums by number, null where there are none. One aggregate, whose state is a row of the result; the distinct numbers are read first."""
    numbers = sorted(r[0] for r in long.select(number).where(F.col(number).isNotNull()).distinct().collect())
    return long.groupBy(key).agg(*[F.sum(F.when(F.col(number) == n, F.col(value))).alias(f"{prefix}{n}") for n in numbers])


def unpivot_days(wide: DataFrame, key: str, epoch: str = "2015-01-01", prefix: str = "d_", total: bool = False) -> DataFrame:
    """(key, OrderDate, Quantity) of columns d_1, d_2, ...: the date comes from the column's name, not from row order."""
    days = [c for c in wide.columns if c.startswith(prefix) and c[len(prefix) :].isdigit()]
    long = wide.unpivot([key], days, "d", "Quantity")
    day = F.substring("d", len(prefix) + 1, 10).cast("int")
    out = long.select(key, F.date_add(F.lit(epoch).cast("date"), day - 1).alias("OrderDate"), F.col("Quantity").cast("double").alias("Quantity"))
    return out.groupBy(key, "OrderDate").agg(F.sum("Quantity").alias("Quantity")) if total else out


def explore_sample(df: DataFrame, keys: Sequence[str], rows: int = 100_000, seed: int = 1, fraction: float | None = None) -> DataFrame:
    """A sample to look at: the ``rows`` rows, or about a share, with the least hashes of their keys and the seed.

    It is the same however the rows lie in files and partitions.
    """
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    if fraction is None:
        return df.withColumn("_hash", hashed).orderBy("_hash", *keys).limit(rows).drop("_hash")
    return df.where(F.conv(F.substring(hashed, 1, 8), 16, 10).cast("long") < F.lit(int(fraction * (1 << 32))))
