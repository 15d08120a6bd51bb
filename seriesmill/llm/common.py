"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space; lines are cut at \n.
WORD = r"[^\x20\x09-\x0D]+"
_own_dir: list[str] = []
#: Paths that have been staged and not removed, in order.
STAGED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, ``spark.checkpoint.dir``. Where it is unset, only a local master gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="seriesmill-"))
    return _own_dir[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/seriesmill/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later jobs reread files and recompute nothing, and a lost executor loses none of them."""
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """The same, with the path, which ``remove`` takes once no plan reads it any more. ``options`` are the writer's."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged path that no plan reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    if path in STAGED:
        STAGED.remove(path)


def frugal(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``; at its end the memory of its batches goes back, as Python workers live on between stages."""

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()

    return run


def text_of(column: str | Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would change other letters too."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` evaluated once, also where ``then`` names it inside a lambda."""
    return F.element_at(F.transform(F.array(value), then), 1)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
