"""Exponentially weighted features.

A recursion over a series has no window function; each series' rows are gathered in order as one array and folded,
which stays in the JVM. An array holds one series, never the table. The fold runs over blocks of about as many rows as
there are blocks, so that a long series is not copied for every row. ``long_series`` is for series that are too long for one task:
they are cut into pieces, which several tasks smooth.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import as_large, change, percent, sign_of
from ..sources.tables import stored
from ..spec import PanelSpec

ALPHAS = (0.1, 0.3, 0.5, 0.7, 0.9)
#: A piece of a long series has up to 2 ** PIECE_BITS rows.
PIECE_BITS = 12


def states_along(rows: Column, before: Column, step: Callable[[Column, Column], Column], first: int = 1) -> Column:
    """A state ``before`` the rows of an array from number ``first`` on, then the states along them, each ``step(state, row)``; in blocks."""
    n = F.greatest(F.size(rows) - (first - 1), F.lit(0))
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    # The state of a row is bound, as the only element of an array: a step names it often.
    bound = lambda done, r: F.element_at(F.transform(F.slice(done, -1, 1), lambda s: step(s, r)), 1)
    along = lambda block, last: F.aggregate(block, F.array(last), lambda done, r: F.concat(done, F.array(bound(done, r))))
    last = lambda done: F.element_at(F.element_at(done, -1), -1)
    blocks = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.ceil(n / size).cast("int") - 1, F.lit(0))),
        F.array(F.array(before)),
        lambda done, i: F.concat(done, F.array(F.slice(along(F.slice(rows, first + i * size, size), last(done)), 2, size))),
    )
    return F.flatten(blocks)


def folded(rows: Column, before: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states along an array of rows, from a state ``before`` them."""
    return F.slice(states_along(rows, before, step), 2, F.size(rows))


def fold_series(panel: DataFrame, spec: PanelSpec, start: Callable[[Column], Column], step: Callable[[Column, Column], Column]) -> DataFrame:
    """``panel`` with the fields of a state that runs along each series: the first row's from ``start``, each further one's from ``step(state, row)``."""
    rows = F.sort_array(F.collect_list(F.struct(F.col(spec.date).alias("_d"), F.struct(*panel.columns).alias("row"))))
    series = panel.groupBy(spec.product).agg(rows.alias("_rows")).select("_rows")
    states = states_along(F.col("_rows"), start(F.element_at("_rows", 1)["row"]), lambda s, r: step(s, r["row"]), 2)
    zipped = series.select(F.explode(F.arrays_zip(F.col("_rows").alias("r"), states.alias("s"))).alias("x"))
    return zipped.select("x.r.row.*", "x.s.*")


def smooth_long(panel: DataFrame, spec: PanelSpec, inputs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """``panel`` with a smoothed column for each name in ``inputs``, of (alpha, value): the same as folding whole series, for series of any length.

    The table is sorted by series and date over all tasks, written, and cut into pieces: what a series has in PIECE rows of a task. Smoothing
    over a piece is an affine map of the state before it, so a piece is summed up by three numbers; those are folded along each
    series, and every piece then runs from the state it begins with. No array holds more than a piece, or a series' maps.
    """
    names = list(inputs)
    columns = {f"_a{i}": alpha.cast("double") for i, (alpha, _) in enumerate(inputs.values())} | {f"_x{i}": value.cast("double") for i, (_, value) in enumerate(inputs.values())}
    ordered = panel.withColumns(columns).orderBy(spec.product, spec.date, spec.value).withColumn("_at", F.monotonically_increasing_id())
    ordered = stored(ordered, "ordered").withColumn("_piece", F.shiftright("_at", PIECE_BITS))

    def pieces(*kept: str | Column) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct("_at", *kept)))
        return ordered.groupBy(F.col(spec.product).alias("_series"), "_piece").agg(rows.alias("_rows"))

    def summed(i: int) -> Column:
        """m and b with which a piece leads a known state s to m * s + b, and own, where it leads if there was none before."""
        none = F.lit(None).cast("double")
        unchanged = F.struct(F.lit(1.0).alias("m"), F.lit(0.0).alias("b"), none.alias("own"))
        a, x = (lambda r: r[f"_a{i}"]), (lambda r: r[f"_x{i}"])
        changed = lambda s, r: F.struct(((1 - a(r)) * s["m"]).alias("m"), (a(r) * x(r) + (1 - a(r)) * s["b"]).alias("b"), blend(a(r), x(r), s["own"]).alias("own"))
        return F.aggregate("_rows", unchanged, lambda s, r: F.when(x(r).isNull(), s).otherwise(changed(s, r)))

    maps = pieces(*columns).select("_series", "_piece", *[summed(i).alias(f"_map{i}") for i in range(len(names))])
    led = lambda s, row, i: F.when(s.isNull(), row[f"_map{i}"]["own"]).otherwise(row[f"_map{i}"]["m"] * s + row[f"_map{i}"]["b"])
    after = fold_series(
        maps, PanelSpec("_series", "_piece", "_piece"),
        lambda row: F.struct(*[row[f"_map{i}"]["own"].alias(f"_s{i}") for i in range(len(names))]),
        lambda s, row: F.struct(*[led(s[f"_s{i}"], row, i).alias(f"_s{i}") for i in range(len(names))]),
    )
    along = Window.partitionBy("_series").orderBy("_piece")
    begins = after.select(F.col("_series").alias("_of"), F.col("_piece").alias("_begins"), F.struct(*[F.lag(f"_s{i}").over(along).alias(n) for i, n in enumerate(names)]).alias("_before"))
    joined = pieces(F.struct(*panel.columns).alias("row"), *columns).join(as_large(begins), (F.col("_piece") == F.col("_begins")) & F.col("_series").eqNullSafe(F.col("_of")))
    step = lambda s, r: F.struct(*[blend(r[f"_a{i}"], r[f"_x{i}"], s[n]).alias(n) for i, n in enumerate(names)])
    zipped = joined.select(F.explode(F.arrays_zip(F.col("_rows").alias("r"), folded(F.col("_rows"), F.col("_before"), step).alias("s"))).alias("x"))
    return zipped.select("x.r.row.*", "x.s.*")


def blend(alpha: float | Column, now: Column, before: Column) -> Column:
    """alpha * now + (1 - alpha) * before; a missing value keeps the state, a missing state takes the value."""
    return F.when(now.isNull(), before).when(before.isNull(), now).otherwise(alpha * now + (1 - alpha) * before)


def ewma(panel: DataFrame, spec: PanelSpec = PanelSpec(), alphas: Sequence[float] = ALPHAS, mode: str = "recursive", long_series: bool = False) -> DataFrame:
    """ewma_10, ewma_30, ...: recursive, or ``two_term`` over the row and the one before. ``long_series`` cuts series into pieces."""
    names = {f"ewma_{percent(a)}": a for a in alphas}
    if mode == "two_term":
        before = F.lag(spec.value).over(spec.w)
        return panel.withColumns({n: blend(a, spec.v, before) for n, a in names.items()})
    if long_series:
        return smooth_long(panel, spec, {n: (F.lit(a), spec.v) for n, a in names.items()})
    value = lambda row: row[spec.value].cast("double")
    return fold_series(
        panel, spec,
        lambda row: F.struct(*[value(row).alias(n) for n in names]),
        lambda s, row: F.struct(*[blend(F.lit(a), value(row), s[n]).alias(n) for n, a in names.items()]),
    )


def ewm_volatility(panel: DataFrame, spec: PanelSpec = PanelSpec(), alphas: Sequence[float] = (0.3, 0.5), mode: str = "recursive", long_series: bool = False) -> DataFrame:
    """ewm_volatility_30, ...: the root of the smoothed square of the deviation from the smoothed value."""
    if long_series and mode == "recursive":
        out = smooth_long(panel, spec, {f"_m{percent(a)}": (F.lit(a), spec.v) for a in alphas})
        out = smooth_long(out, spec, {f"_v{percent(a)}": (F.lit(a), F.pow(spec.v - F.col(f"_m{percent(a)}"), F.lit(2.0))) for a in alphas})
        return out.withColumns({f"ewm_volatility_{percent(a)}": F.sqrt(f"_v{percent(a)}") for a in alphas}).select(*panel.columns, *[f"ewm_volatility_{percent(a)}" for a in alphas])
    if mode == "two_term":
        out = ewma(panel, spec, alphas, mode)
        squares = {f"_sq_{percent(a)}": F.pow(spec.v - F.col(f"ewma_{percent(a)}"), F.lit(2.0)) for a in alphas}
        out = out.withColumns(squares)
        found = {f"ewm_volatility_{percent(a)}": F.sqrt(blend(a, F.col(f"_sq_{percent(a)}"), F.lag(f"_sq_{percent(a)}").over(spec.w))) for a in alphas}
        return out.withColumns(found).drop(*squares, *[f"ewma_{percent(a)}" for a in alphas])
    value = lambda row: row[spec.value].cast("double")

    def state(row: Column, before: Column | None) -> Column:
        fields = []
        for a in alphas:
            n = percent(a)
            mean = value(row) if before is None else blend(F.lit(a), value(row), before[f"_m{n}"])
            square = F.pow(value(row) - mean, F.lit(2.0))
            fields += [mean.alias(f"_m{n}"), (square if before is None else blend(F.lit(a), square, before[f"_v{n}"])).alias(f"_v{n}")]
        return F.struct(*fields)

    out = fold_series(panel, spec, lambda row: state(row, None), lambda s, row: state(row, s))
    hidden = [f"_{k}{percent(a)}" for a in alphas for k in "mv"]
    return out.withColumns({f"ewm_volatility_{percent(a)}": F.sqrt(f"_v{percent(a)}") for a in alphas}).drop(*hidden)


def ewma_crossover(panel: DataFrame, spec: PanelSpec = PanelSpec(), fast: float = 0.7, slow: float = 0.3, signal: float = 0.5, long_series: bool = False) -> DataFrame:
    """ewma_momentum (fast less slow), its own smoothing ewma_signal, their divergence, and the direction."""
    momentum = F.col("ewma_momentum")
    said = {"ewma_divergence": momentum - F.col("ewma_signal"), "ewma_momentum_direction": sign_of(momentum)}
    if long_series:
        out = smooth_long(panel, spec, {"_f": (F.lit(fast), spec.v), "_s": (F.lit(slow), spec.v)}).withColumn("ewma_momentum", F.col("_f") - F.col("_s")).drop("_f", "_s")
        return smooth_long(out, spec, {"ewma_signal": (F.lit(signal), momentum)}).withColumns(said)
    value = lambda row: row[spec.value].cast("double")

    def state(row: Column, s: Column | None) -> Column:
        f = value(row) if s is None else blend(F.lit(fast), value(row), s["_f"])
        g = value(row) if s is None else blend(F.lit(slow), value(row), s["_s"])
        momentum = f - g
        return F.struct(f.alias("_f"), g.alias("_s"), momentum.alias("ewma_momentum"), (momentum if s is None else blend(F.lit(signal), momentum, s["ewma_signal"])).alias("ewma_signal"))

    out = fold_series(panel, spec, lambda row: state(row, None), lambda s, row: state(row, s)).drop("_f", "_s")
    return out.withColumns(said)


def ewma_ratios(panel: DataFrame, spec: PanelSpec = PanelSpec(), alpha: float = 0.3) -> DataFrame:
    """value_to_ewma_ratio (1.0 where the smoothed value is 0) and ewma_growth_rate."""
    name = f"ewma_{percent(alpha)}"
    out = panel if name in panel.columns else ewma(panel, spec, (alpha,))
    e = F.col(name)
    return out.withColumns({"value_to_ewma_ratio": F.when(e == 0, 1.0).otherwise(F.try_divide(spec.v, e)), "ewma_growth_rate": change(e, F.lag(name).over(spec.w))})


def adaptive_ewma(panel: DataFrame, spec: PanelSpec = PanelSpec(), rows: int = 6, long_series: bool = False) -> DataFrame:
    """adaptive_ewma with adaptive_alpha_value from the variation of the last rows about their own trailing means: steady series are smoothed more."""
    trailing = spec.last_rows(rows)
    out = panel.withColumn("_mean", F.avg(spec.v).over(trailing))
    out = out.withColumn("_dev", F.sqrt(F.avg(F.pow(spec.v - F.col("_mean"), F.lit(2.0))).over(trailing)))
    cv = F.when(F.col("_mean") == 0, 0.5).otherwise(F.try_divide("_dev", "_mean"))
    alpha = F.when(cv < 0.2, 0.3).when(cv < 0.5, 0.5).when(cv < 1.0, 0.7).otherwise(0.9)
    out = out.withColumn("adaptive_alpha_value", alpha).drop("_mean", "_dev")
    if long_series:
        return smooth_long(out, spec, {"adaptive_ewma": (F.col("adaptive_alpha_value"), spec.v)})
    value = lambda row: row[spec.value].cast("double")
    return fold_series(
        out, spec,
        lambda row: F.struct(value(row).alias("adaptive_ewma")),
        lambda s, row: F.struct(blend(row["adaptive_alpha_value"], value(row), s["adaptive_ewma"]).alias("adaptive_ewma")),
    )
