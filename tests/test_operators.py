"""Hand-computed cases and invariants of the operators."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from seriesmill import PanelSpec
from seriesmill.functions.quantiles import cuts
from seriesmill.operators import ensemble, ewma, impute, intervals, metrics, panel, quality, reports, series, splits, trend
from seriesmill.operators import models as L
from seriesmill.sources import tables

SPEC = PanelSpec()


def month(n: int) -> dt.date:
    """The end of the n-th month from January 2020 on."""
    y, m = divmod(n, 12)
    y, m = 2020 + (y + (m == 11)), (m + 1) % 12 + 1
    return dt.date(y, m, 1) - dt.timedelta(days=1)


def frame(spark, series: dict[str | None, list[float | None]], start: int = 0):
    rows = [(p, month(start + i), v) for p, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "product string, month_end date, quantity double")


def values(df, *columns):
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.orderBy("product", "month_end").collect()]


def noise(spark, n_series=6, length=30, seed=1, nulls=0.0):
    rng = random.Random(seed)
    value = lambda: None if rng.random() < nulls else float(rng.choice([0, 0, 1, 3, 7, 20]))
    return frame(spark, {f"p{i}": [value() for _ in range(rng.randint(1, length))] for i in range(n_series)})


# --- panel ------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("first", [dt.date(2023, 2, 28), dt.date(2024, 2, 29), dt.date(2023, 4, 30), dt.date(2023, 1, 31)])
def test_month_grid_meets_every_month_end(spark, first):
    last = dt.date(2024, 6, 30)
    df = spark.createDataFrame([("a", first, 5.0), ("a", last, 7.0), ("b", first, 1.0)], "product string, month_end date, quantity double")
    rows = panel.complete_months(df).collect()
    a = sorted(r.month_end for r in rows if r.product == "a")
    assert len(a) == (last.year - first.year) * 12 + last.month - first.month + 1 and a[0] == first and a[-1] == last
    assert all((d + dt.timedelta(days=1)).day == 1 for d in a)
    assert sum(r.quantity for r in rows) == 13.0


def test_grid_keeps_total_and_null_keys(spark):
    df = spark.createDataFrame([(None, month(0), 2.0), (None, month(3), 3.0), ("x", month(1), 1.0)], "product string, month_end date, quantity double")
    rows = panel.complete_months(df).collect()
    assert len(rows) == 5 and sum(r.quantity for r in rows) == 6.0
    assert sum(r.quantity is None for r in panel.complete_months(df, fill=None).collect()) == 2


def test_rollup_sums_repeated_days(spark):
    day = dt.date(2024, 2, 3)
    df = spark.createDataFrame([("a", day, 1.0), ("a", day, 2.0), ("a", dt.date(2024, 2, 29), 4.0), ("a", dt.date(2024, 5, 1), 1.0)], "k string, d date, q double")
    assert values(panel.monthly_rollup(df, "k", "d", "q"), "month_end", "quantity", "min_date", "max_date") == [
        (dt.date(2024, 2, 29), 7.0, dt.date(2024, 2, 29), dt.date(2024, 5, 31)),
        (dt.date(2024, 5, 31), 1.0, dt.date(2024, 2, 29), dt.date(2024, 5, 31)),
    ]


def test_cleaning_is_three_valued(spark):
    rows = [("a", "USD", "Sale", 1.0, 1.0), ("a-9999x", "USD", "Sale", 1.0, 1.0), (None, "USD", "Sale", 1.0, 1.0), ("a", None, "Sale", 1.0, 1.0), ("a", "USD", "ReturnItem", 1.0, 1.0), ("a", "USD", None, 1.0, 1.0), ("a", "USD", "Sale", 0.0, 1.0), ("a", "USD", "Sale", 1.0, None)]
    df = spark.createDataFrame(rows, "k string, c string, t string, q double, p double")
    assert panel.clean_lines(df, "k", "q", excluded_key="%-9999%", equal={"c": "USD"}, differ={"t": "ReturnItem"}, present=["p"]).count() == 1


def test_classes(spark):
    df = frame(spark, {"smooth": [5.0] * 12, "erratic": [1.0, 50.0] * 6, "gaps": [4.0, 0.0, 0.0, 4.0, 0.0, 0.0, 4.0], "once": [0.0, 3.0, 0.0], "never": [0.0] * 4})
    got = {r.product: r for r in panel.class_table(df).collect()}
    assert {k: r.product_category for k, r in got.items()} == {"smooth": "Smooth", "erratic": "Erratic", "gaps": "Intermittent", "once": "Lumpy", "never": "Lumpy"}
    assert got["gaps"].avg_demand_interval == 3.0 and got["once"].cov_quantity is None and got["never"].total_orders == 0
    on_rows = {(r.product, r.product_category, r.total_orders) for r in panel.class_statistics(df).collect()}
    assert on_rows == {(k, r.product_category, r.total_orders) for k, r in got.items()}


def test_classes_as_of_do_not_look_ahead(spark):
    early, late = frame(spark, {"a": [5.0] * 6}), frame(spark, {"a": [900.0, 0.0, 900.0]}, start=6)
    seen = panel.class_statistics(early.union(late), as_of=F.lit(month(5))).collect()
    assert {r.product_category for r in seen} == {"Smooth"} and len(seen) == 9


def test_base_features(spark):
    df = frame(spark, {"a": [2.0, 0.0, 0.0, 8.0, 4.0]})
    out = panel.moving_averages(panel.recency(panel.lags(df)))
    assert values(out, "months_since_last_order") == [0.0, 1.0, 2.0, 0.0, 0.0]
    assert values(out, "last_order_quantity") == [2.0, 2.0, 2.0, 8.0, 4.0]
    assert values(out, "lag_1") == [None, 2.0, 0.0, 0.0, 8.0] and values(out, "lead_month_1") == [0.0, 0.0, 8.0, 4.0, None]
    assert values(out, "ma_4_month") == [2.0, 1.0, 2 / 3, 2.5, 3.0]
    assert values(out, "ma_3_sales") == [2.0, 2.0, 2.0, 5.0, 14 / 3]
    first_zero = panel.moving_averages(panel.recency(frame(spark, {"b": [0.0, 3.0]})))
    assert values(first_zero, "months_since_last_order") == [None, 0.0] and values(first_zero, "ma_3_sales") == [None, 3.0]


def test_unpivot_uses_names(spark):
    wide = spark.createDataFrame([("i", 1, 2, 10), ("i", 3, 4, 20)], "item string, d_2 int, d_1 int, d_10 int")
    got = {(r.OrderDate, r.Quantity) for r in panel.unpivot_days(wide, "item", total=True).collect()}
    assert got == {(dt.date(2015, 1, 1), 6.0), (dt.date(2015, 1, 2), 4.0), (dt.date(2015, 1, 10), 30.0)}


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles(spark, seed):
    rng = random.Random(seed)
    xs = [float(rng.choice([rng.randint(0, 5), rng.randint(0, 1000)])) for _ in range(rng.randint(1, 400))]
    ps = (0.0, 0.1, 0.25, 0.5, 0.8, 0.99, 1.0)
    got = cuts(spark.createDataFrame([(x,) for x in [*xs, None]], "x double"), "x", ps).first()
    xs.sort()
    assert [got[f"q{i}"] for i in range(len(ps))] == [xs[max(0, -(-round(p * len(xs), 6) // 1).__int__() - 1)] for p in ps]


def test_empty_panel(spark):
    df = frame(spark, {})
    assert panel.add_features(df).count() == 0 and panel.latest_month(df).count() == 0
    assert quality.report(df).count() == 7 and quality.overall(quality.report(df)).first()[0] in ("PASS", "UNKNOWN")


# --- imputation -------------------------------------------------------------------------------------------------------

GAPPY = {"a": [None, 4.0, None, None, 10.0, None], "b": [None, None], "c": [1.0]}
EXPECTED = {
    "zero": [0.0, 4.0, 0.0, 0.0, 10.0, 0.0],
    "mean": [7.0, 4.0, 7.0, 7.0, 10.0, 7.0],
    "forward_fill": [0.0, 4.0, 4.0, 4.0, 10.0, 10.0],
    "backward_fill": [4.0, 4.0, 10.0, 10.0, 10.0, 0.0],
    "forward_fill_decay": [0.0, 4.0, 2.0, 1.0, 10.0, 5.0],
    "interpolate": [4.0, 4.0, 6.0, 8.0, 10.0, 10.0],
    "seasonal": [0.0, 4.0, 4.0, 4.0, 10.0, 10.0],
}


@pytest.mark.parametrize("strategy", EXPECTED)
def test_imputers(spark, strategy):
    out = impute.Imputer(strategy, decay_rate=0.5).impute(frame(spark, GAPPY))
    assert values(out, "quantity") == pytest.approx([*EXPECTED[strategy], 0.0, 0.0, 1.0])
    assert out.columns == ["product", "month_end", "quantity"]


def test_seasonal_uses_the_year_before(spark):
    out = impute.Imputer("seasonal").impute(frame(spark, {"a": [float(i) for i in range(12)] + [None, 50.0, None]}))
    assert values(out, "quantity")[12:] == [0.0, 50.0, 2.0]


@pytest.mark.parametrize("strategy", EXPECTED)
def test_imputers_keep_known_values(spark, strategy):
    df = noise(spark, nulls=0.3)
    both = impute.Imputer(strategy).impute(df, output="filled")
    assert both.where("filled is null or (quantity is not null and filled <> quantity)").count() == 0 and both.count() == df.count()


def test_auto_choice(spark):
    cases = [(0.005, 0.9, "zero"), (0.03, 0.9, "forward_fill"), (0.1, 0.5, "zero"), (0.1, 0.1, "forward_fill_decay"), (0.4, 0.1, "seasonal")]
    df = spark.createDataFrame([(n, z) for n, z, _ in cases], "n double, z double")
    assert [r[0] for r in df.select(impute.chosen_strategy(F.col("n"), F.col("z"))).collect()] == [s for *_, s in cases]


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        impute.Imputer("magic").impute(frame(spark, {"a": [1.0]}))


# --- trend and smoothing ------------------------------------------------------------------------------------------------


def test_trend(spark):
    out = trend.trend_features(frame(spark, {"a": [1.0, 2.0, 4.0, 8.0, 0.0, 5.0]}), periods=(1, 3))
    assert values(out, "growth_rate_1m") == [None, 1.0, 1.0, 1.0, -1.0, None]
    assert values(out, "momentum_1m") == [None, None, 0.0, 0.0, -2.0, None]
    assert values(out, "trend_strength_3m") == [None, None, None, 7 / 3, -2 / 3, 1 / 3]
    assert values(out, "relative_position") == pytest.approx([i / 6 for i in range(1, 7)])
    assert values(out, "trend_direction") == [0, 1, 1, 1, -1, 1]
    assert values(out, "cumulative_demand")[-1] == 20.0


def test_even_windows_are_centred_one_early(spark):
    out = trend.detrended(frame(spark, {"a": [1.0, 2.0, 3.0, 4.0, 0.0]}), windows=(3,))
    assert values(out, "trend_3m") == [1.5, 2.0, 3.0, 7 / 3, 2.0]
    zero = trend.detrended(frame(spark, {"a": [0.0, 0.0]}), windows=(3,))
    assert values(zero, "detrended_ratio_3m") == [1.0, 1.0]


def test_change_points(spark):
    out = trend.change_points(frame(spark, {"a": [10.0, 11.0, 30.0, 31.0, 0.0, 5.0]}))
    assert values(out, "is_change_point") == [0, 0, 1, 0, 1, 0]
    assert values(out, "periods_since_change") == [None, None, 0, 1, 0, 1] and values(out, "stable_rows") == [1, 2, 2, 3, 3, 4]


def test_lifecycle_of_zero_start(spark):
    out = trend.lifecycle(frame(spark, {"a": [0.0, 0.0, 4.0, 4.0, 8.0, 8.0, 1.0, 1.0]}))
    assert values(out, "lifecycle_stage") == ["Introduction"] * 2 + ["Growth"] * 2 + ["Maturity"] * 2 + ["Decline"] * 2
    assert values(out, "lifecycle_growth") == [None] * 8


def test_ewma(spark):
    df = frame(spark, {"a": [10.0, 20.0, None, 40.0], "b": [5.0]})
    assert values(ewma.ewma(df, alphas=(0.5,)), "ewma_50") == [10.0, 15.0, 15.0, 27.5, 5.0]
    assert values(ewma.ewma(df, alphas=(0.5,), mode="two_term"), "ewma_50") == [10.0, 15.0, 20.0, 40.0, 5.0]
    assert "ewma_29" in ewma.ewma(df, alphas=(0.29,)).columns
    assert values(ewma.ewm_volatility(df, alphas=(0.5,)), "ewm_volatility_50")[:2] == pytest.approx([0.0, 12.5**0.5])


@pytest.mark.parametrize("feature", [trend.trend_features, trend.detrended, trend.lifecycle, trend.change_points, ewma.ewma, ewma.ewm_volatility, ewma.ewma_crossover, ewma.adaptive_ewma, panel.class_statistics])
def test_features_keep_rows(spark, feature):
    df = noise(spark, seed=4, nulls=0.1)
    assert feature(df).select("product", "month_end").exceptAll(df.select("product", "month_end")).count() == 0 and feature(df).count() == df.count()


# --- quality, splits, metrics -------------------------------------------------------------------------------------------


def test_quality_keeps_zero(spark):
    row = quality.statistics(frame(spark, {"a": [0.0, 0.0]}), "quantity").first()
    assert (row["min"], row["max"], row["mean"], row["cv"]) == (0.0, 0.0, 0.0, None)
    assert quality.iqr_outliers(frame(spark, {"a": [1.0, 1.0]})).first()["iqr_rate"] == 0.0


def test_missing_counts_nan(spark):
    assert quality.missing(frame(spark, {"a": [1.0, float("nan"), None, 2.0]})).first()["n_missing"] == 2


@pytest.mark.parametrize("sliding", [False, True])
@pytest.mark.parametrize("gap", [0, 2])
def test_folds_do_not_leak(spark, sliding, gap):
    df = frame(spark, {"a": [1.0] * 30})
    table = splits.folds(df, n_splits=4, min_train=10, test=3, gap=gap, sliding=sliding).orderBy("fold").collect()
    assert table
    for f in table:
        months = (f.test_from.year - f.train_to.year) * 12 + f.test_from.month - f.train_to.month
        assert f.train_from <= f.train_to and months == 1 + gap and f.test_to <= month(29)
    if sliding:
        assert len({(f.train_to - f.train_from).days // 28 for f in table}) == 1
    assert splits.folds(df, min_train=40).count() == 0


def test_holdout_is_in_time_and_keeps_duplicates(spark):
    df = frame(spark, {"a": [1.0] * 10})
    early, late = splits.holdout(df.union(df))
    assert early.count() + late.count() == 20 and early.agg(F.max("month_end")).first()[0] < late.agg(F.min("month_end")).first()[0]


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0), (4.0, 5.0), (None, 3.0)], "label double, prediction double")
    row = metrics.evaluate(df).first()
    assert (row.rmse, row.mae, row.mape) == (1.0, 1.0, pytest.approx(37.5)) and row.r2 == pytest.approx(1 - 1 / (8 / 3))


def test_stop(spark):
    scores = [10, 8, 7.9, 7.95, 7.99, 1.0]
    df = spark.createDataFrame([(i, float(s)) for i, s in enumerate(scores, 1)], "iteration int, score double")
    row = metrics.best_stop(df, patience=3, min_delta=0.5).first()
    assert (row.stop_iteration, row.best_iteration, row.best_score) == (5, 3, 7.9)


# --- ensembles, intervals, reports --------------------------------------------------------------------------------------


def test_ensembles(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (1.0, None, 3.0)], "a double, b double, c double")
    out = df.select(ensemble.simple_average("abc").alias("avg"), ensemble.row_median("abc").alias("med"), ensemble.weighted_average("abc", {"a": 3, "c": 1}).alias("w")).collect()
    assert [r.avg for r in out] == [3.0, None] and [r.med for r in out] == [2.0, 1.0] and out[0].w == pytest.approx(2.25)


def test_weights_sum_to_one(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 2.0, 4.0)], "label double, a double, b double")
    got = {r.model: r.weight for r in ensemble.weight_table(df, ["a", "b"]).collect()}
    assert sum(got.values()) == pytest.approx(1.0) and got["a"] > got["b"]


def test_intervals(spark):
    df = spark.createDataFrame([("a", month(i), float(10 + i % 3), 10.0) for i in range(20)], "product string, month_end date, label double, prediction double")
    for kind in (intervals.normal_intervals, intervals.quantile_intervals, lambda d: intervals.bootstrap_intervals(d, ["product", "month_end"])):
        out = kind(df)
        assert out.where("lower_bound > upper_bound or lower_bound < 0").count() == 0
        assert 0 <= intervals.coverage(out).first().coverage <= 1
    alone = intervals.normal_intervals(df.limit(1)).first()
    assert alone.upper_bound - alone.lower_bound == pytest.approx(2 * 1.959964, abs=1e-4)


def test_champions(spark):
    df = spark.createDataFrame([("x", m, r) for m, r in (("a", 2.0), ("b", 1.0), ("c", 3.0))], "category string, model string, rmse double")
    assert {(r.model, r.role) for r in reports.champions(df).collect()} == {("b", "champion"), ("a", "challenger")}


# --- series, models, sources --------------------------------------------------------------------------------------------


def test_croston(spark):
    got = {r.product: r.croston for r in series.croston(frame(spark, {"a": [0.0, 6.0, 0.0, 0.0, 12.0], "none": [0.0, 0.0]}), alpha=0.5).collect()}
    assert got == {"a": pytest.approx(9.0 / 2.5), "none": 0.0}


def test_holt_winters_follows_a_line(spark):
    got = series.holt_winters(frame(spark, {"a": [float(i) for i in range(30)], "b": [7.0]}), 3, season=3).orderBy("product", "month_end").collect()
    assert [r.holt_winters for r in got[:3]] == pytest.approx([30.0, 31.0, 32.0], abs=1.5) and [r.holt_winters for r in got[3:]] == [7.0] * 3
    assert got[0].month_end == month(30)


def test_shuffle_keeps_values(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(50)], "a int, b int")
    out = L.shuffled(df, "b", 3)
    assert sorted(r.b for r in out.collect()) == [i * 10 for i in range(50)] and sorted(r.a for r in out.collect()) == list(range(50))
    assert out.where("b <> a * 10").count() > 30


def test_contract(spark, tmp_path):
    good = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0)], tables.DAILY)
    assert tables.validate(good) == (True, "")
    bad = spark.createDataFrame([(1, "x", "y"), (2, None, "3")], "item_id int, OrderDate string, Quantity string")
    ok, said = tables.validate(bad)
    assert not ok and "item_id is not a string" in said and "OrderDate is no date: 1" in said and "null in OrderDate: 1" in said
    assert not tables.validate(good.drop("Quantity"))[0]
    tables.write_csv(good, f"{tmp_path}/x.csv", single_file=True)
    assert tables.read_any(spark, f"{tmp_path}/x.csv").collect() == good.collect()
    with pytest.raises(ValueError):
        tables.read_any(spark, "x.xls")
    tables.write_managed(good, "seriesmill_daily")
    assert spark.table("seriesmill_daily").count() == 1
    spark.sql("drop table seriesmill_daily")


def test_streaming_rollup(spark, tmp_path):
    from seriesmill.streaming.rollup import merge_months, monthly_stream

    days = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(120)]
    lines = spark.createDataFrame([("a", d, 1.0) for d in days], "k string, d timestamp, q double")
    lines.write.parquet(f"{tmp_path}/in")
    stream = monthly_stream(spark.readStream.schema(lines.schema).parquet(f"{tmp_path}/in"), "k", "d", "q", "1 day")
    query = stream.writeStream.format("memory").queryName("closed_days").option("checkpointLocation", f"{tmp_path}/check").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    months = merge_months(spark.createDataFrame([], "product string, month_end date, quantity double"), spark.table("closed_days"))
    assert {r.month_end: r.quantity for r in months.collect()}[dt.date(2024, 2, 29)] == 29.0


def test_seasonal_smoothing_of_a_long_series(spark):
    """The last values of one place of the season count, however many come before them."""
    n = 100_060
    days = spark.range(n).select(F.lit("a").alias("product"), F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).alias("month_end"), F.when(F.col("id") >= n - 50, 100.0).otherwise(0.0).alias("quantity"))
    found = series.seasonal_smoothing(days, season=1, alphas=(0.5,)).collect()
    assert len(found) == 1 and found[0].level > 99.9


def test_permutation_importance_query_scores_every_feature(spark):
    from seriesmill.plans import model_queries

    found = model_queries.permutation_importance(spark, "/root/testdata/sf0.001").collect()
    assert {r.feature for r in found} == set(model_queries.FEATURES) and any(r["std"] > 0 for r in found)


# --- models against plain versions --------------------------------------------------------------------------------------


def model_frame(spark, n=240, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, z = rng.uniform(-3, 3), rng.uniform(-3, 3)
        rows.append((f"p{i % 6}", month(i // 6), "Smooth" if i % 2 else "Lumpy", x, z, 2.0 * x + (0.5 * z * z if i % 2 else 0.0) + rng.uniform(-0.1, 0.1)))
    return spark.createDataFrame(rows, "product string, month_end date, product_category string, x double, z double, y double").repartition(3)


def rmse_of(rows, prediction="prediction", label="y"):
    pairs = [(r[label], r[prediction]) for r in rows]
    return (sum((a - b) ** 2 for a, b in pairs) / len(pairs)) ** 0.5


def parts(df):
    cut = F.lit(month(29))
    return df.where(F.col("month_end") <= cut), df.where(F.col("month_end") > cut)


def test_models_per_category_are_lines_of_their_class(spark):
    np = pytest.importorskip("numpy")
    from pyspark.ml.regression import LinearRegression

    df = model_frame(spark)
    models = L.train_per_category(df, {"line": LinearRegression(labelCol="y", solver="normal")}, ["x", "z"])
    assert set(models) == {("Smooth", "line"), ("Lumpy", "line")}
    scored = L.score(models, df).collect()
    assert len(scored) == df.count()
    for category in ("Smooth", "Lumpy"):
        rows = [r for r in df.collect() if r.product_category == category]
        a = np.array([[1, r.x, r.z] for r in rows])
        w = np.linalg.lstsq(a, np.array([r.y for r in rows]), rcond=None)[0]
        want = {(r.product, r.month_end): float(v) for r, v in zip(rows, a @ w)}
        assert {(r["product"], r.month_end): r.prediction for r in scored if r.SalesPattern == category} == pytest.approx(want)


def test_grids_pick_the_depth_that_fits(spark):
    from pyspark.ml.regression import DecisionTreeRegressor

    train, test = parts(model_frame(spark))
    tree = DecisionTreeRegressor(labelCol="y", seed=1)
    deep = L.train(train, tree, ["x", "z"], {"maxDepth": [0, 4]}, n_folds=2)
    assert deep.stages[-1].depth > 1
    best, model = L.train_in_time(train, tree, ["x", "z"], [{"maxDepth": 0}, {"maxDepth": 4}], n_splits=2, min_train=10, test=4)
    assert best == {"maxDepth": 4} and model.stages[-1].depth > 1
    curve = {r.value: r for r in L.validation_curve(train, test, tree, "maxDepth", [0, 4], ["x", "z"]).collect()}
    for depth, r in curve.items():
        one = L.train(train, tree.copy({tree.maxDepth: int(depth)}), ["x", "z"])
        assert (r.train_rmse, r.validation_rmse) == pytest.approx((rmse_of(one.transform(train).collect()), rmse_of(one.transform(test).collect())))
    assert L.best_value(spark.createDataFrame([(1.0, 0.1, 3.0), (2.0, 0.2, 2.0)], "value double, train_rmse double, validation_rmse double")).first().best_value == 2.0


def test_forest_and_boosting_curves(spark):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

    train, test = parts(model_frame(spark))
    forest = L.train(train, RandomForestRegressor(labelCol="y", numTrees=4, seed=3, maxDepth=3), ["x", "z"])
    rows = forest.stages[0].transform(test)
    rows = rows.collect()
    got = {r.iteration: r.score for r in L.forest_curve(train, test, ["x", "z"], "y", counts=(1, 4), seed=3, maxDepth=3).collect()}
    for n in (1, 4):
        mean = [sum(t.predict(r.features) for t in forest.stages[-1].trees[:n]) / n for r in rows]
        assert got[n] == pytest.approx((sum((r.y - m) ** 2 for r, m in zip(rows, mean)) / len(rows)) ** 0.5)
    curve = [r.score for r in L.boosting_curve(train, test, ["x", "z"], "y", most=5, maxDepth=2).orderBy("iteration").collect()]
    for n in (1, 5):
        one = L.train(train, GBTRegressor(labelCol="y", maxIter=n, seed=42, maxDepth=2), ["x", "z"])
        assert curve[n - 1] == pytest.approx(rmse_of(one.transform(test).collect()) ** 2)
    stop = L.boosting_stop(train, test, ["x", "z"], label="y", most=5, maxDepth=2).first()
    assert stop.best_score == pytest.approx(min(curve[: stop.stop_iteration]))


def test_boosting_stops_while_it_grows(spark):
    """The trees are those of the library's full fit up to the stop, and there are no more of them."""
    df = model_frame(spark)
    noisy = df.withColumn("y", F.col("y") + 6 * F.rand(3))
    train, test = parts(noisy)
    full = [r.score for r in L.boosting_curve(train, test, ["x", "z"], "y", most=14, maxDepth=4).orderBy("iteration").collect()]
    model, curve = L.grow_boosting(train, test, ["x", "z"], "y", most=14, maxDepth=4, patience=2, min_delta=0.05)
    assert curve == pytest.approx(full[: len(curve)]) and model.getNumTrees == len(curve) < 14
    best = [min(curve[: i + 1]) for i in range(len(curve))]
    assert all(curve[-k] >= best[-3] - 0.05 for k in (1, 2))
    stop = L.boosting_stop(train, test, ["x", "z"], label="y", most=14, maxDepth=4, patience=2, min_delta=0.05).first()
    assert stop.stop_iteration == len(curve) and stop.best_score == pytest.approx(min(curve))


def test_forest_curve_has_one_plan_for_any_number_of_trees(spark):
    train, test = parts(model_frame(spark))
    lengths = [len(L.forest_curve(train, test, ["x", "z"], "y", counts=counts, maxDepth=2)._jdf.queryExecution().optimizedPlan().toString()) for counts in ((2, 5), (20, 50))]
    assert abs(lengths[0] - lengths[1]) < 100


def test_a_stack_in_time_does_not_trust_a_model_that_overfits(spark):
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

    df = model_frame(spark).withColumn("y", F.col("x") + F.randn(5))
    base = [LinearRegression(), DecisionTreeRegressor(maxDepth=12, seed=1)]
    own, in_time = ensemble.fit_stack(df, base, ["x", "z"], "y"), ensemble.fit_stack_in_time(df, base, ["x", "z"], "y", n_splits=3, min_train=15, test=6)
    assert own.stages[-1].coefficients[1] > 0.8 and abs(in_time.stages[-1].coefficients[1]) < 0.3 and in_time.stages[-1].coefficients[0] > 0.6
    rows = ensemble.out_of_fold(df, base, ["x", "z"], "y", n_splits=3, min_train=15, test=6)
    bounds = {f.fold: f for f in splits.folds(df, n_splits=3, min_train=15, test=6).collect()}
    assert all(bounds[r.fold].train_to < r.month_end for r in rows.collect()) and rows.count() > 0
    with pytest.raises(ValueError):
        ensemble.out_of_fold(df, base, ["x", "z"], "y", min_train=500)


def test_scoring_is_one_pass(spark, tmp_path):
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    model_frame(spark).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    holes = df.withColumn("z", F.when(F.col("x") < 2.5, F.col("z")))
    found = L.train_per_category(df, {"line": LinearRegression(labelCol="y"), "trees": GBTRegressor(labelCol="y", maxIter=3, maxDepth=2, seed=1)}, ["x", "z"], ["Smooth", "Lumpy", "Erratic"])
    found |= L.train_per_category(df, {"short": LinearRegression(labelCol="y")}, ["x"], ["Smooth", "Lumpy"])
    out = L.score(found, holes)
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan") == 1
    want = []
    for (category, name), model in found.items():
        rows = model.transform(holes.where(F.col("product_category") == category))
        want += [(r["product"], r.month_end, r.y, r.prediction, category, name) for r in rows.collect()]
    key = lambda r: (r[0], r[1], r[4], r[5], r[2])
    got = sorted(map(tuple, out.collect()), key=key)
    want.sort(key=key)
    assert len(got) == len(want) > 0 and all(a[:3] == b[:3] and a[4:] == b[4:] and a[3] == pytest.approx(b[3]) for a, b in zip(got, want))


def test_permutation_importance_is_that_of_single_deals(spark):
    from pyspark.ml.regression import LinearRegression
    from seriesmill.operators import metrics

    df = model_frame(spark)
    line, rows = L.train(df, LinearRegression(labelCol="y"), ["x", "z"]), df.select("x", "z", "y")
    ordered = L.in_random_order(rows, 42)
    n, error = ordered.count(), lambda d: metrics.evaluate(line.transform(d), "y").first()["rmse"]
    got = {r.feature: r for r in L.permutation_importance(line, df, ["z", "x"], repeats=2).collect()}
    for i, f in enumerate(("z", "x")):
        losses = [error(L.dealt(ordered, n, f, 42 + 2 * i + k)) - error(rows) for k in range(2)]
        assert (got[f].importance, got[f]["std"]) == pytest.approx((sum(losses) / 2, abs(losses[0] - losses[1]) / 2), abs=1e-9)
    plan = L.permutation_importance(line, df, ["z", "x"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_n") <= 2 * plan.count("BroadcastNestedLoopJoin") + 2


def test_importances_find_the_feature_that_matters(spark):
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor

    df = model_frame(spark)
    native = L.native_importance(L.train(df, RandomForestRegressor(labelCol="y", numTrees=5, seed=1), ["x", "z"]), df).collect()
    assert [r.feature for r in native] == ["x", "z"] and sum(r.importance for r in native) == pytest.approx(1.0)
    line = L.train(df, LinearRegression(labelCol="y"), ["x", "z"])
    one, two = ({r.feature: r.importance for r in L.permutation_importance(line, d, ["x", "z"]).collect()} for d in (df, df.repartition(7)))
    assert one == pytest.approx(two) and one["x"] > 10 * abs(one["z"]) and one["x"] > 1
    scores = {r.features: r for r in L.selection_scores(*parts(df), LinearRegression(labelCol="y"), ["x", "z"], ["x"]).collect()}
    assert scores["all"].n_features == 2 and scores["selected"].n_features == 1 and scores["selected"].rmse < 2 * scores["all"].rmse


def test_shuffling_depends_on_rows_alone(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(200)], "a int, b int")
    one, two = (sorted(map(tuple, L.shuffled(d, "b", 3).collect())) for d in (df, df.repartition(9)))
    assert one == two and one != sorted(map(tuple, L.shuffled(df, "b", 4).collect()))


def test_stack_is_a_line_of_base_predictions(spark):
    np = pytest.importorskip("numpy")
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression

    df = model_frame(spark)
    out = ensemble.fit_stack(df, [LinearRegression(), DecisionTreeRegressor(maxDepth=3, seed=1)], ["x", "z"], "y").transform(df).collect()
    a = np.array([[1, r.base_0, r.base_1] for r in out])
    w = np.linalg.lstsq(a, np.array([r.y for r in out]), rcond=None)[0]
    assert [r.prediction for r in out] == pytest.approx((a @ w).tolist(), abs=1e-6)


def test_cross_validation_and_walk_forward_with_callables(spark):
    df = frame(spark, {"a": [float(i) for i in range(20)], "b": [2.0 * i for i in range(20)]})
    mean = lambda rows: rows.agg(F.avg("quantity")).first()[0]
    out = {r.metric: r for r in splits.cross_validate(df, mean, lambda m, rows: {"mean": m, "n": rows.count()}, n_splits=2, min_train=10, test=3).collect()}
    bounds = splits.folds(df, n_splits=2, min_train=10, test=3).collect()
    means = [1.5 * sum(range(len([i for i in range(20) if month(i) <= f.train_to]))) / len([i for i in range(20) if month(i) <= f.train_to]) for f in bounds]
    assert out["n"]["mean"] == 6 and out["mean"]["mean"] == pytest.approx(sum(means) / len(means))
    got = splits.walk_forward_fit(df, mean, lambda m, rows: rows.withColumn("prediction", F.lit(m)), initial=12, refit_every=3, horizon=2).collect()
    steps = {r.step: r for r in splits.walk_forward(df, initial=12, refit_every=3, horizon=2).collect()}
    assert len(got) == 2 * len(steps) == 14
    for r in got:
        known = [i for i in range(20) if month(i) <= steps[r.step].refit_to]
        assert r.month_end == steps[r.step].test_date and r.prediction == pytest.approx(1.5 * sum(known) / len(known))


def test_bootstrap_draws_residuals(spark):
    """Bounds are residuals of the calibration rows, also the outermost; more rows change nothing for a row."""
    n = 3_000
    known = spark.createDataFrame([("k", month(i), float(10 + (1_000 if i == 7 else i % 5)), 10.0) for i in range(n)], "product string, month_end date, label double, prediction double")
    rows = spark.createDataFrame([(f"r{i}", month(i % 40), 0.0, 50.0) for i in range(400)], "product string, month_end date, label double, prediction double")
    out = intervals.bootstrap_intervals(rows, ["product", "month_end"], level=0.99, calibration=known).collect()
    assert {r.upper_bound - 50 for r in out} <= {0.0, 1.0, 2.0, 3.0, 4.0, 1_000.0} and any(r.upper_bound == 1_050 for r in out)
    few = {(r["product"], r.month_end): r.upper_bound for r in intervals.bootstrap_intervals(rows.limit(30), ["product", "month_end"], level=0.99, calibration=known).collect()}
    assert all(few[(r["product"], r.month_end)] == r.upper_bound for r in out if (r["product"], r.month_end) in few)
    none = intervals.bootstrap_intervals(rows.limit(2), ["product", "month_end"], calibration=known.limit(0)).collect()
    assert len(none) == 2 and all(r.lower_bound is None and r.upper_bound is None for r in none)


def test_long_series_are_folded_whole(spark):
    """A fold over blocks is the plain recursion, for any length about a square."""
    series_ = {f"s{n}": [float((i * 7) % 11) for i in range(n)] for n in (1, 2, 3, 4, 5, 9, 10, 16, 17, 26, 500)}
    rows = [(p, dt.date(2000, 1, 1) + dt.timedelta(days=i), v) for p, vs in series_.items() for i, v in enumerate(vs)]
    got = {}
    for r in ewma.ewma(spark.createDataFrame(rows, "product string, month_end date, quantity double"), alphas=(0.3,)).orderBy("month_end").collect():
        got.setdefault(r["product"], []).append(r.ewma_30)
    for p, vs in series_.items():
        want, state = [], None
        for v in vs:
            state = v if state is None else 0.3 * v + 0.7 * state
            want.append(state)
        assert got[p] == pytest.approx(want)


def quantile(values, weights, p):
    """The plain version: the first value, in order, that reaches the rank."""
    total, done = sum(weights), 0
    for x, w in sorted(zip(values, weights), key=lambda v: (v[0] != v[0], v[0] if v[0] == v[0] else 0)):
        done += w
        if done >= max(1, -int(-round(p * total, 6) // 1)):
            return x


@pytest.mark.parametrize("kind", ["double", "long", "date", "decimal(30,3)", "timestamp"])
def test_quantiles_by_refinement(spark, monkeypatch, kind):
    """Small histograms, so that brackets are narrowed again and again; every kind of column, hot values, very different sizes."""
    from decimal import Decimal

    from seriesmill.functions import quantiles

    monkeypatch.setattr(quantiles, "CELLS", 8)
    monkeypatch.setattr(quantiles, "FEW", 2)
    rng = random.Random(len(kind))
    make = {
        "double": lambda: rng.choice([0.0, rng.gauss(0, 1), 10 ** rng.uniform(-300, 300), -(10 ** rng.uniform(-5, 5)), float("inf"), float("-inf"), float("nan")]),
        "long": lambda: rng.choice([0, rng.randrange(50), rng.randrange(-(2**63), 2**63), 2**60 + rng.randrange(3)]),
        "date": lambda: dt.date(2000, 1, 1) + dt.timedelta(days=rng.choice([0, rng.randrange(400)])),
        "decimal(30,3)": lambda: Decimal(rng.choice([0, rng.randrange(10**27), 10**26 + rng.randrange(5)])).scaleb(-3),
        "timestamp": lambda: dt.datetime(2000, 1, 1) + dt.timedelta(microseconds=rng.choice([0, rng.randrange(10**15), 7 + rng.randrange(3)])),
    }[kind]
    xs, ws = [make() for _ in range(300)], [rng.choice([0, 1, 1, 5, 1000]) for _ in range(300)]
    ps = (0.0, 0.05, 0.3, 0.5, 0.5, 0.77, 0.95, 1.0)
    df = spark.createDataFrame([*zip(xs, ws), (None, 5)], f"x {kind}, w int").repartition(3)
    for weight, weights in ((None, [1] * 300), ("w", ws)):
        got = cuts(df, "x", ps, weight).first()
        assert repr([got[f"q{i}"] for i in range(len(ps))]) == repr([quantile(xs, weights, p) for p in ps])


def test_values_that_are_ranked_do_not_grow_with_the_table(spark, monkeypatch):
    from seriesmill.functions import quantiles

    monkeypatch.setattr(quantiles, "CELLS", 256)
    monkeypatch.setattr(quantiles, "FEW", 64)
    seen, plain_bracket = [], quantiles.Bracket

    class Seen(plain_bracket):
        def __init__(self, lo, hi, before, values):
            super().__init__(lo, hi, before, values)
            seen.append(values)

    monkeypatch.setattr(quantiles, "Bracket", Seen)
    for n in (3_000, 30_000):
        df = spark.range(n).select(F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.pow(F.col("id").cast("double"), F.lit(1.7))).alias("x"))
        seen.clear()
        got = cuts(df, "x", (0.1, 0.5, 0.75, 0.99)).first()
        assert [got.q0, got.q1] == [0.0, 0.0] and got.q2 == pytest.approx((2 * (n // 4) - 1) ** 1.7)
        assert seen[-1] <= 64


def test_quantiles_of_nothing_and_no_tables_left(spark):
    import os

    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file://") + "/seriesmill"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    assert cuts(spark.createDataFrame([(None,)], "x double"), "x", (0.5, 1.0)).collect() == [(None, None)]
    assert set(os.listdir(root)) == before


def test_rank_index_has_no_hot_task(spark):
    """Half of the values are equal: no partition of the index, and none of its buckets, has over twice the median of rows."""
    from seriesmill.functions.numbering import buckets, rank_index, values_at

    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.sin(F.col("id").cast("double"))).alias("x"))
    index = rank_index(df, "x")
    xs = sorted(r.x for r in df.collect())
    want, at = {}, 0
    for r in index.orderBy("x").collect():
        want[r.x] = (r.rows, r.start)
        assert r.start == at and xs[at] == r.x
        at += r.rows
    assert at == len(xs)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = sorted(r["count"] for r in index.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    table = buckets(index)
    assert table.agg(F.max(F.size("at"))).first()[0] <= 257
    rng = random.Random(1)
    ks = [0, len(xs) - 1, *[rng.randrange(len(xs)) for _ in range(300)]]
    rows = spark.createDataFrame([(k, k) for k in ks], "k long, v long")
    assert all(xs[r.k] == r.v for r in values_at(rows, ["v"], table).collect())
    gone = values_at(spark.createDataFrame([(None,), (10**9,)], "v long"), ["v"], table).collect()
    assert [r.v for r in gone] == [None, None]


def test_sample_by_keys_does_not_depend_on_partitions(spark):
    df = noise(spark, length=60)
    for options in ({"rows": 20}, {"fraction": 0.3}):
        one, two = (sorted(map(tuple, panel.explore_sample(d, ["product", "month_end"], **options).collect())) for d in (df, df.repartition(7)))
        assert one == two and 0 < len(one) < df.count()


def test_numbers_follow_the_order(spark):
    from seriesmill.functions.numbering import numbered

    df = spark.createDataFrame([((i * 37) % 501,) for i in range(501)], "x int").repartition(6)
    assert {(r.x, r.n) for r in numbered(df, ["x"], "n").collect()} == {(i, i) for i in range(501)}
    assert numbered(df.limit(0), ["x"], "n").count() == 0


def scans(df):
    import io
    from contextlib import redirect_stdout

    text = io.StringIO()
    with redirect_stdout(text):
        df.explain()
    return text.getvalue().split("Initial Plan")[0].count("lineitem")


@pytest.mark.parametrize("name", ["ensemble_strategies", "intervals_quantile", "quality_report", "drift", "base_features", "fold_metrics"])
def test_panels_are_built_once(spark, name):
    """Lines are scanned for one build of the panel, which is then read from a written table."""
    from seriesmill.plans import registry

    assert scans(registry.QUERIES[name](spark, "/root/testdata/sf0.001")) == 0


def test_stored_tables_are_removed(spark):
    import os

    tables.remove_stored(spark)
    df = tables.stored(spark.range(5), "five")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert df.count() == 5 and os.path.isdir(folder)
    assert tables.remove_stored(spark) == 1 and not os.path.isdir(folder) and tables.remove_stored(spark) == 0
