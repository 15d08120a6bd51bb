"""Panels that stand for users' tables, made from the given tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import by_series
from ..operators.panel import MONTHLY, class_statistics, clean_lines, complete_months, monthly_rollup
from ..sources.tables import stored

SPEC = MONTHLY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean order lines: part, supplier, day and quantity."""
    rows = clean_lines(table(spark, sf_dir, "lineitem"), "l_partkey", "l_quantity", differ={"l_returnflag": "R"}, present=["l_extendedprice"])
    return rows.select(F.concat(F.lit("P"), "l_partkey").alias("part"), F.concat(F.lit("S"), "l_suppkey").alias("supplier"), F.col("l_shipdate").cast("date").alias("d"), F.col("l_quantity").alias("q"))


def part_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rollup(lines(spark, sf_dir), "part", "d", "q").select("product", "month_end", "quantity")


def supplier_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monthly_rollup(lines(spark, sf_dir), "supplier", "d", "q").select("product", "month_end", "quantity")


def mixed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse parts, dense suppliers, and suppliers with a peak every sixth month: all four classes."""
    dense = supplier_months(spark, sf_dir)
    peak = F.when(F.month("month_end") % 6 == 0, F.col("quantity") * 10).otherwise(F.col("quantity"))
    peaked = dense.select(F.regexp_replace("product", "^S", "E").alias("product"), "month_end", peak.alias("quantity"))
    return part_months(spark, sf_dir).unionByName(dense).unionByName(peaked)


def dealt(monthly: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months in tasks by series. There are at most as many as lines, which files can say without being read."""
    return by_series(monthly, table(spark, sf_dir, "lineitem").count())


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_months(dealt(mixed_months(spark, sf_dir), spark, sf_dir))


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as a written table, for operators that read it more than once."""
    return stored(panel(spark, sf_dir), "panel")


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complete_months(dealt(part_months(spark, sf_dir), spark, sf_dir), fill=None)


def _thinned(dense: DataFrame, modulus: int) -> DataFrame:
    hit = (F.substring("product", 2, 20).cast("long") * 7 + F.month("month_end")) % modulus == 0
    return dense.withColumn("quantity", F.when(~hit, F.col("quantity")))


def few_nulls(spark: SparkSession, sf_dir: str, modulus: int = 17) -> DataFrame:
    """All series with about one value in ``modulus`` taken out: sparse demand as well as dense."""
    return _thinned(panel(spark, sf_dir), modulus)


def few_nulls_dense(spark: SparkSession, sf_dir: str, modulus: int = 17) -> DataFrame:
    """The same of the suppliers' series, which sell in most months: shares of missing values alone decide on a strategy there."""
    return _thinned(complete_months(dealt(supplier_months(spark, sf_dir), spark, sf_dir)), modulus)


MODELS = ("pred_naive", "pred_ma4", "pred_snaive")


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(product, month_end, category, label, three predictions) of all series, written once: next month's value, by three plain rules."""
    w = SPEC.w
    rows = class_statistics(panel(spark, sf_dir)).select(
        "product", "month_end", F.col("product_category").alias("category"), F.lead("quantity").over(w).alias("label"),
        F.col("quantity").alias("pred_naive"), F.avg("quantity").over(SPEC.last_rows(4)).alias("pred_ma4"), F.lag("quantity", 11).over(w).alias("pred_snaive"),
    )
    return stored(rows.na.drop(), "forecasts")


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, day, value): a daily series per type of event."""
    return table(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.round(F.sum("value"), 4).alias("value"))


LINES = """
lines as (
  select 'P' || l_partkey as part, 'S' || l_suppkey as supplier, cast(l_shipdate as date) as d, l_quantity as q
  from lineitem where l_returnflag <> 'R' and l_quantity > 0 and l_extendedprice is not null),
part_months as (select part as product, last_day(d) as month_end, sum(q) as quantity from lines group by 1, 2),
supplier_months as (select supplier as product, last_day(d) as month_end, sum(q) as quantity from lines group by 1, 2),
peaked as (select 'E' || product[2:] as product, month_end, case when month(month_end) % 6 = 0 then quantity * 10 else quantity end as quantity from supplier_months),
mixed as (from part_months union all from supplier_months union all from peaked),
bounds as (select product, min(month_end) as lo, max(month_end) as hi from mixed group by 1),
grid as (select product, last_day(cast(unnest(generate_series(date_trunc('month', lo)::timestamp, date_trunc('month', hi)::timestamp, interval 1 month)) as date)) as month_end from bounds),
holes as (select product, month_end, quantity from grid left join mixed using (product, month_end)),
panel as (select product, month_end, coalesce(quantity, 0.0) as quantity from holes),
gaps as (from holes where product like 'P%'),
few as (
  select product, month_end, case when (cast(product[2:] as bigint) * 7 + month(month_end)) % 17 <> 0 then quantity end as quantity
  from panel),
few_dense as (from few where product like 'S%')
"""

CLASSES = """
steps as (
  select *, case when quantity > 0 then date_diff('month', last_value(case when quantity > 0 then month_end end ignore nulls)
    over (partition by product order by month_end rows between unbounded preceding and 1 preceding), month_end) end as gap
  from panel),
classes as (
  select product, count(*) filter (quantity > 0) as total_orders,
    stddev_samp(quantity) filter (quantity > 0) / avg(quantity) filter (quantity > 0) as cov_quantity, avg(gap) as avg_demand_interval
  from steps group by 1),
classed as (
  select *, case when cov_quantity <= 0.8 and avg_demand_interval <= 1.5 then 'Smooth' when cov_quantity > 0.8 and avg_demand_interval <= 1.5 then 'Erratic'
    when cov_quantity <= 0.8 and avg_demand_interval > 1.5 then 'Intermittent' else 'Lumpy' end as product_category
  from classes)
"""

FORECASTS = """
forecasts as (
  select * from (
    select product, month_end, product_category as category, lead(quantity) over w as label, quantity as pred_naive,
      avg(quantity) over (w rows 3 preceding) as pred_ma4, lag(quantity, 11) over w as pred_snaive
    from panel join classed using (product)
    window w as (partition by product order by month_end))
  where label is not null and pred_snaive is not null),
long as (select product, month_end, category, label, model, prediction from (unpivot forecasts on pred_naive, pred_ma4, pred_snaive into name model value prediction))
"""


def sql(body: str, *ctes: str) -> str:
    """A statement over the fixtures' tables."""
    return f"with {', '.join(x.strip() for x in (LINES, *ctes))} {body}"
