"""Queries of the panel: cleaning, roll-up, gap filling, base features, profiles, reshaping, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_large, rounded, rounded_doubles
from ..functions.quantiles import cuts
from ..operators import panel as P
from ..operators import quality
from ..sources import tables
from ..sources.tables import stored
from . import fixtures as X
from .fixtures import CLASSES, sql

BASE_ROUNDED = ("months_since_last_order", "cov_quantity", "avg_demand_interval", "ma_4_month", "ma_8_month", "ma_12_month", "ma_3_sales", "ma_5_sales", "ma_7_sales", "avg_demand_quantity")
BASE_PLAIN = ("product", "month_end", "quantity", "last_order_quantity", "lag_1", "lag_2", "lag_3", "lag_4", "lag_5", "lead_month_1", "total_orders", "product_category", "bucket")
CORRELATED = ("quantity", "lag_1", "lag_2", "lag_3", "lead_month_1")


def demand_class_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = P.category_profile(P.class_table(X.panel(spark, sf_dir)))
    return profile.select("product_category", "n_series", *rounded(["mean_cov", "mean_interval"]))


def clean_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.monthly_rollup(X.lines(spark, sf_dir), "part", "d", "q")


def clean_lines_by_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = P.clean_lines(X.table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", excluded_key="%NOT SPECIFIED%", differ={"o_orderstatus": "P"}, present=["o_orderdate"])
    rows = orders.join(as_large(X.table(spark, sf_dir, "lineitem")), F.col("o_orderkey") == F.col("l_orderkey"))
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))


def complete_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return X.panel(spark, sf_dir)


def base_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.add_features(stored(X.mixed_months(spark, sf_dir), "months"))
    return out.select(*BASE_PLAIN, F.col("month").cast("int").alias("month"), F.col("year").cast("int").alias("year"), *rounded_doubles(BASE_ROUNDED))


def class_statistics_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes as they were known at the end of 1998, on all rows since."""
    out = P.class_statistics(X.panel(spark, sf_dir), as_of=F.lit("1998-12-31").cast("date")).where("month_end > date'1998-12-31'")
    return out.select("product", "month_end", "total_orders", *rounded(["cov_quantity", "avg_demand_interval"]), "product_category")


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = P.long_enough(P.class_statistics(P.lags(X.panel(spark, sf_dir))))
    return P.model_rows(panel, "Intermittent", ["lag_1", "lag_2", "lead_month_1"]).select("product", "month_end", "lag_1", "lag_2", "lead_month_1")


def latest_month_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.latest_month(X.panel(spark, sf_dir)).select("product", "month_end", "quantity")


def demand_buckets_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = P.demand_buckets(X.panel(spark, sf_dir), per_product=True).select("product", F.round("avg_demand_quantity", 6).alias("avg_demand_quantity"), "bucket")
    return out.distinct()


def zero_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.zero_profile(X.panel(spark, sf_dir)).select("product", "total_months", "zero_months", F.round("zero_rate", 6).alias("zero_rate"))


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_profile(X.gaps(spark, sf_dir)).select("column", "n_null", F.round("null_percent", 6).alias("null_percent"))


def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.correlations(P.lags(X.panel(spark, sf_dir)), list(CORRELATED)).select("a", "b", F.round("r", 6).alias("r"))


def intake_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = quality.profile(X.lines(spark, sf_dir), "part", "d", "q")
    return p.select("n_rows", *rounded(["mean", "stddev"]), "min", "max", "n_items", "first_date", "last_date")


def _as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales as text with some broken values, as a CSV would bring them."""
    rows = X.lines(spark, sf_dir)
    day, n = F.dayofmonth("d"), F.substring("part", 2, 20).cast("long")
    return rows.select(
        F.when(n % 50 != 0, F.col("part")).alias("item_id"),
        F.when(day == 29, "no date").otherwise(F.col("d").cast("string")).alias("OrderDate"),
        F.when(n % 31 == 0, "many").otherwise(F.col("q").cast("int").cast("string")).alias("Quantity"),
    )


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.violations(_as_text(spark, sf_dir))


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_audit(_as_text(spark, sf_dir))


def load_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.load_clean(_as_text(spark, sf_dir)).groupBy("item_id").agg(F.count("*").alias("n_days"), F.sum("Quantity").alias("quantity"))


def decimal_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = X.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))
    out = P.decimals_to_double(rows)
    return out.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.round(F.max("price"), 2).alias("highest"), F.round(F.min("price"), 2).alias("lowest"))


def quantity_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts(X.mixed_months(spark, sf_dir), "quantity", [k / 10 for k in range(1, 10)])


def unpivot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months as columns d_n, n counted from January 1970, and back, as days from 2015-01-01 on; months outside a series are null."""
    months = X.panel(spark, sf_dir).withColumn("m", (F.year("month_end") - 1970) * 12 + F.month("month_end"))
    return P.unpivot_days(P.pivot_days(months, "product", "m", "quantity"), "product")


def managed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales saved as a managed table, totals by year read back from it; a second save replaces the first, and the table goes in the end."""
    daily = X.lines(spark, sf_dir).groupBy(F.col("part").alias("item_id"), F.col("d").alias("OrderDate")).agg(F.sum("q").alias("Quantity"))
    name = f"seriesmill_daily_{uuid.uuid4().hex}"
    for _ in range(2):
        tables.write_managed(daily, name)
    totals = spark.table(name).groupBy(F.year("OrderDate").alias("year")).agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("n_items"), F.sum("Quantity").alias("quantity"))
    out = tables.stored(totals, "yearly")
    spark.sql(f"drop table {name}")
    return out


def files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales through CSV, Parquet and JSON files, read back by suffix or format."""
    path = tables.scratch_path(spark, "files")
    daily = X.lines(spark, sf_dir).select(F.col("part").alias("item_id"), F.col("d").alias("OrderDate"), F.col("q").alias("Quantity"))
    tables.write_csv(daily, f"{path}/a.csv")
    tables.write_parquet(daily, f"{path}/b.parquet")
    tables.write_json(daily, f"{path}/c.json")
    from_json = tables.cast_to(tables.read_table(spark, f"{path}/c.json", "json"), tables.DAILY)
    read = {"csv": tables.read_any(spark, f"{path}/a.csv"), "parquet": tables.read_any(spark, f"{path}/b.parquet"), "json": from_json}
    out = None
    for name, df in read.items():
        row = df.agg(F.lit(name).alias("format"), F.count("*").alias("n"), F.sum("Quantity").alias("quantity"), F.max("OrderDate").alias("last_date"))
        out = row if out is None else out.unionByName(row)
    return out


def exploration_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the panel's rows, by the hash of their keys."""
    return P.explore_sample(X.panel(spark, sf_dir), ["product", "month_end"], fraction=0.1, seed=3)


def exploration_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel's 1,000 rows with the least hashes of their keys."""
    return P.explore_sample(X.panel(spark, sf_dir), ["product", "month_end"], rows=1_000)


QUERIES = {f.__name__: f for f in (
    demand_class_profile, clean_rollup, clean_lines_by_priority, complete_months, base_features, class_statistics_as_of, training_rows, latest_month_rows, demand_buckets_per_series, zero_profile,
    null_profile, correlation_matrix, intake_profile, contract_violations, load_audit, load_clean, decimal_columns, quantity_deciles, unpivot_days, files_round_trip, managed_table, exploration_sample, exploration_rows,
)}

_TEXT = """
text as (
  select case when part[2:]::bigint % 50 <> 0 then part end as item_id, case when day(d) = 29 then 'no date' else d::varchar end as day,
    case when part[2:]::bigint % 31 = 0 then 'many' else q::int::varchar end as qty
  from lines)
"""
_MA = lambda n: f"round(avg(quantity) over (w rows {n - 1} preceding), 6) as ma_{n}_month"
_SALES = lambda n: f"round(avg(case when quantity > 0 then quantity end) over (partition by product order by sold range between {n - 1} preceding and current row), 6) as ma_{n}_sales"
_SEEN = """
seen as (select *, sum(case when quantity > 0 then 1 else 0 end) over (partition by product order by month_end)::bigint as sold, avg(quantity) over (partition by product) as mean_q from panel),
cuts as (select quantile_disc(mean_q, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q from seen)
"""
_BASE = f"""
select product, month_end, quantity, month(month_end)::int as month, year(month_end)::int as year,
  date_diff('month', last_value(case when quantity > 0 then month_end end ignore nulls) over (w rows unbounded preceding), month_end)::double as months_since_last_order,
  last_value(case when quantity > 0 then quantity end ignore nulls) over (w rows unbounded preceding) as last_order_quantity,
  {', '.join(f'lag(quantity, {n}) over w as lag_{n}' for n in range(1, 6))}, lead(quantity) over w as lead_month_1,
  total_orders, round(cov_quantity, 6) as cov_quantity, round(avg_demand_interval, 6) as avg_demand_interval, product_category,
  {', '.join(map(_MA, (4, 8, 12)))}, {', '.join(map(_SALES, (3, 5, 7)))},
  round(mean_q, 6) as avg_demand_quantity, 'B' || (1 + len(list_filter((select q from cuts), lambda c: c < mean_q))) as bucket
from seen join classed using (product) window w as (partition by product order by month_end)
"""

ORACLE_SQL = {
    "demand_class_profile": sql("select product_category, count(*) as n_series, round(avg(cov_quantity), 6) as mean_cov, round(avg(avg_demand_interval), 6) as mean_interval from classed group by 1", CLASSES),
    "clean_rollup": sql("select *, min(month_end) over (partition by product) as min_date, max(month_end) over (partition by product) as max_date from part_months"),
    "clean_lines_by_priority": "select o_orderpriority, count(*) as n_lines, sum(l_quantity) as quantity from orders join lineitem on o_orderkey = l_orderkey where o_orderpriority not like '%NOT SPECIFIED%' and o_orderstatus <> 'P' and o_totalprice > 0 and o_orderdate is not null group by 1",
    "complete_months": sql("from panel"),
    "base_features": sql(_BASE, CLASSES, _SEEN),
    "class_statistics_as_of": sql(
        "select panel.product, panel.month_end, total_orders, round(cov_quantity, 6) as cov_quantity, round(avg_demand_interval, 6) as avg_demand_interval, product_category from panel join late_classed using (product) where panel.month_end > date '1998-12-31'",
        CLASSES.replace(" quantity > 0", " quantity > 0 and month_end <= date '1998-12-31'").replace("(quantity > 0", "(quantity > 0 and month_end <= date '1998-12-31'").replace("classes as", "late as").replace("from classes", "from late").replace("classed as", "late_classed as"),
    ),
    "training_rows": sql(
        "select product, month_end, lag_1, lag_2, lead_month_1 from (select product, month_end, lag(quantity) over w as lag_1, lag(quantity, 2) over w as lag_2, lead(quantity) over w as lead_month_1 from panel window w as (partition by product order by month_end)) join classed using (product) where total_orders >= 5 and product_category = 'Intermittent' and lag_2 is not null and lead_month_1 is not null",
        CLASSES,
    ),
    "latest_month_rows": sql("from panel where month_end = (select max(month_end) from panel)"),
    "demand_buckets_per_series": sql(
        "select product, round(m, 6) as avg_demand_quantity, 'B' || (1 + len(list_filter((select q from cuts), lambda c: c < m))) as bucket from means",
        "means as (select product, avg(quantity) as m from panel group by 1), cuts as (select quantile_disc(m, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) as q from means)",
    ),
    "zero_profile": sql("select product, count(*) as total_months, count(*) filter (quantity = 0) as zero_months, round(count(*) filter (quantity = 0) / count(*), 6) as zero_rate from panel group by 1"),
    "null_profile": sql("select * from (select 'product' as column, 0::bigint as n_null, 0.0::double as null_percent union all select 'month_end', 0, 0.0 union all select 'quantity', count(*) - count(quantity), round(100 * (count(*) - count(quantity)) / count(*), 6) from gaps)"),
    "correlation_matrix": sql(
        " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from l" for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1 :]),
        "l as (select quantity, lag(quantity) over w as lag_1, lag(quantity, 2) over w as lag_2, lag(quantity, 3) over w as lag_3, lead(quantity) over w as lead_month_1 from panel window w as (partition by product order by month_end))",
    ),
    "intake_profile": sql("select count(*) as n_rows, round(avg(q), 6) as mean, round(stddev_samp(q), 6) as stddev, min(q) as min, max(q) as max, count(distinct part) as n_items, min(d) as first_date, max(d) as last_date from lines"),
    "contract_violations": sql("select * from (select 'null in item_id' as rule, count(*) filter (item_id is null) as n from text union all select 'Quantity is no double', count(*) filter (try_cast(qty as double) is null) from text union all select 'OrderDate is no date', count(*) filter (try_cast(day as date) is null) from text) where n > 0", _TEXT),
    "load_audit": sql("select count(*) as n_before, count(*) filter (ok) as n_kept, count(*) filter (not ok) as n_removed from (select item_id is not null and try_cast(day as date) is not null and try_cast(qty as double) is not null as ok from text)", _TEXT),
    "load_clean": sql("select item_id, count(*) as n_days, sum(qty::double) as quantity from text where item_id is not null and try_cast(day as date) is not null and try_cast(qty as double) is not null group by 1", _TEXT),
    "decimal_columns": "select l_linenumber, count(*) as n, round(max(l_extendedprice::decimal(12,2)::double), 2) as highest, round(min(l_extendedprice::decimal(12,2)::double), 2) as lowest from lineitem group by 1",
    "quantity_deciles": sql("select " + ", ".join(f"quantile_disc(quantity, {k / 10}) as q{k - 1}" for k in range(1, 10)) + " from mixed"),
    "unpivot_days": sql("select product, (date '2015-01-01' + ((year(month_end) - 1970) * 12 + month(month_end) - 1)::int)::date as \"OrderDate\", quantity as \"Quantity\" from (select distinct product from panel) cross join (select distinct month_end from panel) left join panel using (product, month_end)"),
    "managed_table": sql("select year(d)::int as year, count(*) as n, count(distinct part) as n_items, sum(q) as quantity from (select part, d, sum(q) as q from lines group by 1, 2) group by 1"),
    "exploration_sample": sql("select product, month_end, quantity from panel where ('0x' || substr(md5(concat_ws('|', '3', product, month_end)), 1, 8))::bigint < (0.1::double * 4294967296)::bigint"),
    "exploration_rows": sql("select product, month_end, quantity from panel order by md5(concat_ws('|', '1', product, month_end)), product, month_end limit 1000"),
    "files_round_trip": sql("select format, count(*) as n, sum(q) as quantity, max(d) as last_date from lines, (values ('csv'), ('parquet'), ('json')) v(format) group by 1"),
}
