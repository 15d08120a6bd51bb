"""Readers, writers and the daily-sales contract. Paths work through Spark's own file systems."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Daily long sales, the canonical input.
DAILY = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("OrderDate", T.DateType()), T.StructField("Quantity", T.DoubleType())])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, spark.checkpoint.dir. Where it is unset, only a local master gets a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = root or tempfile.mkdtemp(prefix="seriesmill-")
    return f"{root.rstrip('/')}/seriesmill/{name}-{uuid.uuid4().hex}"


#: Paths that ``stored`` has written and ``remove_stored`` has not removed.
STORED: list[str] = []


def stored_at(df: DataFrame, name: str, *partition_by: str) -> tuple[DataFrame, str]:
    """``df`` as a written table, and its path, which ``remove`` takes once no frame that was made from it is needed."""
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, for what is read again and again: fits reread files, and lost executors lose nothing.

    It stays until ``remove_stored``, as frames that are made from it are lazy.
    """
    out, path = stored_at(df, name)
    STORED.append(path)
    return out


def remove_stored(spark: SparkSession) -> int:
    """Remove all that ``stored`` has written, once no frame that was made from it is needed; how many tables these were."""
    n = len(STORED)
    while STORED:
        remove(spark, STORED.pop())
    return n


def read_csv(spark: SparkSession, path: str, schema: T.StructType = DAILY) -> DataFrame:
    """CSV with a header, read as strings by the schema's names and cast; what can't be cast is null."""
    raw = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema])).option("header", True).csv(path)
    return cast_to(raw, schema)


def read_any(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV or Parquet, by the path's suffix."""
    suffix = path.rstrip("/").rpartition(".")[2].lower()
    if suffix == "csv":
        return read_csv(spark, path, schema or DAILY)
    if suffix == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"neither .csv nor .parquet: {path}")


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table at a path in any installed format (``delta`` where its jar is)."""
    return spark.read.format(fmt).load(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header. One file means one task, so it is off by default."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_managed(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def write_json(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, each cast; null where a value can't be."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def violations(df: DataFrame, item: str = "item_id", date: str = "OrderDate", quantity: str = "Quantity") -> DataFrame:
    """(rule, n) for every rule that is broken, from one aggregate over all rows: missing columns, kinds, nulls, values that can't be cast."""
    spark, kinds = df.sparkSession, {f.name: f.dataType for f in df.schema}
    wanted = (item, date, quantity)
    static = [(f"missing column {c}", 1) for c in wanted if c not in kinds]
    if item in kinds and not isinstance(kinds[item], T.StringType):
        static.append((f"{item} is not a string", 1))
    lost = lambda c, t: F.count_if(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(t).isNull())
    counted: list[Column] = [F.count_if(F.col(c).isNull()).alias(f"null in {c}") for c in wanted if c in kinds]
    counted += [lost(c, t).alias(f"{c} is no {t}") for c, t in ((quantity, "double"), (date, "date")) if c in kinds]
    out = spark.createDataFrame(static, "rule string, n long")
    if counted:
        row = df.agg(*counted)
        out = out.union(row.unpivot([], row.columns, "rule", "n"))
    return out.where("n > 0")


def validate(df: DataFrame, **names: str) -> tuple[bool, str]:
    """Whether the contract holds, and what is broken."""
    broken = violations(df, **names).orderBy("rule").collect()
    return not broken, "; ".join(f"{r.rule}: {r.n}" for r in broken)


def load_clean(df: DataFrame, schema: T.StructType = DAILY) -> DataFrame:
    """Rows in the contract's types, without those that have a null."""
    return cast_to(df, schema).na.drop()


def load_audit(df: DataFrame, schema: T.StructType = DAILY) -> DataFrame:
    """One row: rows before, kept and removed by ``load_clean``."""
    whole = [F.col(f.name).try_cast(f.dataType).isNotNull() for f in schema]
    kept = whole[0]
    for c in whole[1:]:
        kept &= c
    return df.agg(F.count("*").alias("n_before"), F.count_if(kept).alias("n_kept")).withColumn("n_removed", F.col("n_before") - F.col("n_kept"))
