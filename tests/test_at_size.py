"""Plans and paths that only large tables take, on small ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F
from seriesmill.functions import deals, numbering
from seriesmill.operators import ensemble, ewma, series, splits
from seriesmill.operators import models as L
from seriesmill.operators import panel as panels
from seriesmill.operators.metrics import evaluate
from seriesmill.sources import tables


def built(df):
    return df._jdf.queryExecution().executedPlan().toString()


def many_months(spark, tmp_path):
    """A panel whose file is far below Spark's limit for broadcasts."""
    days = spark.range(3_000).select(F.concat(F.lit("p"), F.col("id") % 100).alias("product"), F.last_day(F.add_months(F.lit("2000-01-01").cast("date"), (F.col("id") / 100).cast("int"))).alias("month_end"), F.lit(1.0).alias("quantity"))
    days.write.parquet(str(tmp_path / "panel"))
    return spark.read.parquet(str(tmp_path / "panel"))


def test_tables_of_series_are_not_broadcast(spark, tmp_path):
    panel = many_months(spark, tmp_path)
    forecasts = panel.select("product", "month_end", F.col("quantity").alias("prediction"))
    walked = splits.walk_forward_means(panel, splits.walk_forward(panel))
    joined = {
        "accuracy": series.forecast_accuracy(forecasts, panel, ["prediction"]),
        "seasonal": series.seasonal_forecast(panel, series.seasonal_smoothing(panel), 12),
        "ensemble": ensemble.join_predictions([forecasts, forecasts], ["a", "b"]),
        "dealt": L.shuffled(panel.select("product", "quantity"), "quantity", 1),
        "walked": walked,
    }
    for name, df in joined.items():
        # Steps, their index of dates and the starts of numbered rows are small tables; all else is sorted and merged.
        assert "SortMergeJoin" in built(df), name
        if name in ("accuracy", "seasonal", "ensemble"):
            assert "BroadcastHashJoin" not in built(df), name
    assert walked.count() == 100 * 6


def repeated(spark):
    """Few distinct rows, each many times."""
    rows = spark.range(4_000).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("z"))
    return rows.withColumn("y", F.col("x") * 3 - F.col("z") * F.col("z") + F.when(F.rand(1) < 0.5, 1.0).otherwise(0.0)).cache()


def test_packs_of_equal_rows_fit_the_same_models(spark, monkeypatch):
    df = repeated(spark)
    line, tree = LinearRegression(labelCol="y", solver="normal"), DecisionTreeRegressor(labelCol="y", maxDepth=3, seed=1)
    grow = lambda: L.grow_boosting(df, df, ["x", "z"], "y", most=4, maxDepth=2)[1]
    one = [L.train(df, e, ["x", "z"]).stages[-1] for e in (line, tree)]
    losses = grow()
    monkeypatch.setattr(L, "FEW_ROWS", 300)
    packs = L.in_packs(df, ["x", "z", "y"])[0]
    assert packs.count() <= 300 + df.distinct().count() < df.count() / 8 and packs.agg(F.sum(L.WEIGHT)).first()[0] == df.count()
    two = [L.train(df, e, ["x", "z"]).stages[-1] for e in (line, tree)]
    assert two[0].coefficients.toArray() == pytest.approx(one[0].coefficients.toArray()) and two[0].intercept == pytest.approx(one[0].intercept)
    for r in df.select("x", "z").distinct().collect():
        assert two[1].predict(Vectors.dense(r.x, r.z)) == pytest.approx(one[1].predict(Vectors.dense(r.x, r.z)))
    assert grow() == pytest.approx(losses)
    deep = L.train(df, RandomForestRegressor(labelCol="y", seed=1), ["x", "z"], {"maxDepth": [0, 4], "numTrees": [3]}, n_folds=2)
    assert max(t.depth for t in deep.stages[-1].trees) > 1


def test_forests_grow_in_lots(spark, monkeypatch):
    """Memory for a row is that of a lot's trees; the lots make one forest."""
    df = repeated(spark)
    monkeypatch.setattr(L, "LOT", 3)
    for few in (L.FEW_ROWS, 300):
        monkeypatch.setattr(L, "FEW_ROWS", few)
        forest = L.fit_forest(df, ["x", "z"], "y", 8, 5, maxDepth=3)
        trees = forest.stages[-1].trees
        assert len(trees) == 8 and len({t.toDebugString.split("\n", 1)[1] for t in trees}) > 3
        got = {r.iteration: r.score for r in L.forest_curve(df, df, ["x", "z"], "y", counts=(2, 8), seed=5, maxDepth=3).collect()}
        rows = df.groupBy("x", "z", "y").count().collect()
        for n in (2, 8):
            error = sum(r["count"] * (r.y - sum(t.predict(Vectors.dense(r.x, r.z)) for t in trees[:n]) / n) ** 2 for r in rows)
            assert got[n] == pytest.approx((error / df.count()) ** 0.5)


def test_wide_tables_come_from_one_aggregate(spark):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("a", 12, None), ("b", 2, 0.0), (None, 12, 4.0), ("c", None, 1.0)], "k string, n int, v double")
    wide = panels.pivot_days(rows, "k", "n", "v")
    want = rows.groupBy("k").pivot("n", [1, 2, 12]).agg(F.sum("v")).collect()
    assert wide.columns == ["k", "d_1", "d_2", "d_12"] and sorted(map(str, map(tuple, wide.collect()))) == sorted(map(str, map(tuple, want)))
    assert "pivotfirst" not in built(wide)


def test_a_large_table_is_counted_once_for_all_its_fits(spark, monkeypatch):
    df = repeated(spark).withColumns({"month_end": F.last_day(F.add_months(F.lit("2000-01-31").cast("date"), F.pmod(F.hash("x", "z", "y"), F.lit(20)))), "product": F.lit("p"), "product_category": F.when(F.col("x") > 2, "Smooth").otherwise("Lumpy")})
    tree, line = DecisionTreeRegressor(labelCol="y", maxDepth=2, seed=1), LinearRegression(labelCol="y", solver="normal")

    def work():
        curve = [tuple(r) for r in L.validation_curve(df, df.where("x > 1"), tree, "maxDepth", [0, 2], ["x", "z"]).collect()]
        chosen = [tuple(r)[1:] for r in L.selection_scores(df, df, line, ["x", "z"], ["x"]).collect()]
        best, model = L.train_in_time(df, tree, ["x", "z"], [{"maxDepth": 0}, {"maxDepth": 2}], n_splits=2, min_train=8, test=4)
        classes = L.train_per_category(df, {"line": line, "tree": tree}, ["x", "z"])
        said = [m.stages[-1].predict(Vectors.dense(x, z)) for m in (model, *(classes[k] for k in sorted(classes))) for x in (0.0, 3.0, 6.0) for z in (0.0, 4.0)]
        return [v for row in (*curve, *chosen, said) for v in row] + [best["maxDepth"]]

    one, passes, real = work(), [], L.counted
    monkeypatch.setattr(L, "FEW_ROWS", 300)
    monkeypatch.setattr(L, "counted", lambda rows, columns: (passes.append(1) if L.WEIGHT not in rows.columns else None) or real(rows, columns))
    assert work() == pytest.approx(one) and len(passes) == 4


def test_missing_features_only_count_for_models_that_have_them(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 1.0, 2.5), (3.0, 5.0, 2.0), (4.0, None, 9.0), (5.0, float("nan"), 7.0), (None, 1.0, 3.0)], "x double, z double, y double")
    got = {r.features: r.rmse for r in L.selection_scores(df, df, LinearRegression(labelCol="y"), ["x", "z"], ["x"]).collect()}
    for name, features in (("all", ["x", "z"]), ("selected", ["x"])):
        e = L.evaluate(L.train(df, LinearRegression(labelCol="y"), features).transform(df), "y").first()
        assert got[name] == pytest.approx(e.rmse)


def test_stacks_of_packs_are_those_of_rows(spark, monkeypatch):
    df = repeated(spark).withColumn("month_end", F.last_day(F.add_months(F.lit("2000-01-31").cast("date"), F.pmod(F.hash("x", "z", "y"), F.lit(20)))))
    base = [LinearRegression(solver="normal"), DecisionTreeRegressor(maxDepth=2, seed=1)]
    points = df.select("x", "z", "y").distinct()

    def said():
        stacks = [ensemble.fit_stack(df, base, ["x", "z"], "y", use_features=True), ensemble.fit_stack_in_time(df, base, ["x", "z"], "y", n_splits=2, min_train=8, test=5)]
        return [r.prediction for m in stacks for r in m.transform(points).orderBy("x", "z", "y").collect()]

    one, read, real = said(), [], ensemble.packs_of
    monkeypatch.setattr(L, "FEW_ROWS", 300)
    monkeypatch.setattr(ensemble, "packs_of", lambda counts, columns: read.append(real(counts, columns)) or read[-1])
    assert said() == pytest.approx(one, rel=1e-6) and len(read) == 2


def test_a_fold_is_computed_once(spark):
    df = spark.createDataFrame([("a", 1, 2.0)], "product string, month_end int, quantity double")
    text = built(ewma.ewma(df, alphas=(0.5,)))
    assert text.count("sequence(") == 1 and "array_sort(" not in text


def test_tasks_along_series_are_dealt_by_rows(spark, monkeypatch):
    from seriesmill.functions import columns
    from seriesmill.plans import fixtures, forecast_queries

    monkeypatch.setattr(columns, "SERIES_ROWS", 500)
    few = "/root/testdata/sf0.001"
    n = -(-fixtures.table(spark, few, "lineitem").count() // 500)
    assert n > 4 and fixtures.panel(spark, few).rdd.getNumPartitions() == n
    rows = fixtures.forecasts(spark, few).count()
    # The forecasts are read from files, and the stop of each series is found where its rows are dealt to.
    text = built(forecast_queries.early_stop(spark, few))
    assert "hashpartitioning(product#" in text and f", {-(-rows // 500)}), REPARTITION_BY_NUM" in text and text.count("Exchange") == 1


def test_only_drawn_ends_become_numbers(spark):
    import hashlib

    from seriesmill.operators import intervals

    known = spark.range(500).select((F.col("id") * F.col("id")).cast("double").alias("label"), F.lit(0.0).alias("prediction"))
    rows = spark.createDataFrame([("a", 1, 0.0, 3.0), ("b", None, 0.0, 5.0), (None, None, 0.0, 7.0)], "k string, m int, label double, prediction double")
    out = intervals.bootstrap_intervals(rows, ["k", "m"], calibration=known)
    for r in out.collect():
        digests = [hashlib.md5("|".join(["1", str(i), *[str(x) for x in (r.k, r.m) if x is not None]]).encode()).hexdigest() for i in range(1, 26)]
        drawn = sorted(int(d[8 * j : 8 * j + 8], 16) for d in digests for j in range(4))
        lo, hi = (int(drawn[k] / 2**32 * 500) ** 2 for k in (2, 97))
        assert (r.lower_bound, r.upper_bound) == (r.prediction + lo, r.prediction + hi)
    assert "conv(substring(" not in built(out)


def test_features_along_series_are_one_window(spark):
    monthly = spark.createDataFrame([("a", "2000-01-31", 2.0), ("a", "2000-04-30", 8.0), ("a", "2000-05-31", 4.0)], "product string, d string, quantity double")
    out = panels.add_features(monthly.select("product", F.col("d").cast("date").alias("month_end"), "quantity"))
    assert [(r.ma_3_sales, r.months_since_last_order, r.total_orders) for r in out.orderBy("month_end").collect()] == [(2.0, 0.0, 3), (2.0, 1.0, 3), (2.0, 2.0, 3), (5.0, 0.0, 3), (pytest.approx(14 / 3), 0.0, 3)]
    # One completes the months, one runs along them, one holds for whole series.
    plan = built(out)
    assert plan.split("== Initial Plan ==")[-1].count("Window [") == 3


def test_deals_of_many_blocks_are_single_deals(spark, monkeypatch):
    """Blocks and lots that end within the table, whole numbers, a column dealt twice and one that is not dealt."""
    monkeypatch.setattr(deals, "PLACE_BITS", 5)
    monkeypatch.setattr(deals, "LOT_VALUES", 60)
    df = spark.range(333).select((F.col("id") % 50).cast("int").alias("a"), (F.col("id") * 0.5).alias("b"), F.col("id").alias("c")).repartition(3)
    ordered = L.in_random_order(df, 7)
    assert sorted(r["_n"] for r in ordered.select("_n").collect()) == list(range(333))
    wanted = [("b", 1), ("a", 2), ("b", 3)]
    got = {r.c: r for r in deals.dealt_all(ordered, 333, df.columns, wanted).collect()}
    rows = {r["_n"]: r for r in ordered.collect()}
    assert len(got) == 333
    for k, (column, seed) in enumerate(wanted):
        assert {c: r[f"_dealt{k}"] for c, r in got.items()} == {r.c: r[column] for r in L.dealt(ordered, 333, column, seed).collect()}
    assert {(r.a, r.b, r.c) for r in got.values()} == {(r.a, r.b, r.c) for r in rows.values()}
    for n in (0, 1):
        few = L.in_random_order(df.limit(n), 7)
        assert [tuple(r)[3:] for r in deals.dealt_all(few, n, df.columns, wanted).collect()] == [(r.b, r.a, r.b) for r in few.collect()]


def test_products_of_large_deals_do_not_overflow():
    for n in (1 << 31, (1 << 31) + 11, (1 << 45) + 7):
        a, numbers = n - 3, [0, 1, 65_536, n // 3, n - 1]
        assert deals.times(a, np.array(numbers, np.uint64), n).tolist() == [a * i % n for i in numbers]


def test_permutation_importance_scores_once_from_one_shuffle_of_packs(spark):
    """Values are dealt in packs, not in a record each, and the score that all are compared with is not computed again."""
    df = repeated(spark)
    for estimator in (LinearRegression(labelCol="y"), DecisionTreeRegressor(labelCol="y", maxDepth=3, seed=1)):
        model = L.train(df, estimator, ["x", "z"])
        plan = built(L.permutation_importance(model, df, ["z", "x"]))
        assert plan.count("MapInArrow") == 1 and "NestedLoop" not in plan and "SortMerge" not in plan
    n, error = df.count(), lambda d: evaluate(model.transform(d), "y").first()["rmse"]
    got = {r.feature: r.importance for r in L.permutation_importance(model, df, ["z", "x"], repeats=1).collect()}
    ordered = L.in_random_order(df.select("x", "z", "y"), 42)
    assert got == pytest.approx({f: error(L.dealt(ordered, n, f, 42 + i)) - error(df) for i, f in enumerate(("z", "x"))}, abs=1e-9)


def test_equal_rows_are_numbered_in_many_tasks(spark):
    same = spark.range(4_000).select(F.lit(1.0).alias("x"), F.lit(2.0).alias("y")).repartition(4)
    placed = numbering.numbered(same, ["x", "y"], "_n", 4)
    assert sorted(r["_n"] for r in placed.collect()) == list(range(4_000))
    files = spark.read.parquet(tables.STORED[-1]).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 4 and max(r["count"] for r in files) < 2_000


def test_features_of_models_are_two_windows_of_a_series(spark, tmp_path):
    rows = many_months(spark, tmp_path).withColumn("quantity", F.when(F.hash("product", "month_end") % 3 == 0, F.hash("month_end", "product") % 1000 / 7))
    cut = F.lit("2001-06-30").cast("date")
    one = panels.model_features(rows, as_of=cut)
    each = panels.class_statistics(panels.moving_averages(panels.lags(panels.calendar(rows), steps=(1, 2)), months=(4,), sales=()), as_of=cut)
    assert one.columns == each.columns and one.exceptAll(each).count() == each.exceptAll(one).count() == 0 and one.where("ma_4_month is null").count() > 0
    assert built(one).count("Window [") == 2 < built(each).count("Window [")
