"""Shuffled shards by a two-pass external shuffle, in DataFrame functions only.

First pass: every record is written to the shared folder with its place and a bucket, a seeded hash of the place, so that buckets
fill uniformly whatever the records hold: equal rows, equal ids and equal texts scatter like others. There are as many buckets
as the table has ``bucket_bytes``, ``most_buckets`` at most. Second pass: a bucket goes to one task, gets a Fisher-Yates shuffle
of its own (``shuffle`` of its numbers 0 to n - 1, seeded by the shuffle's seed and the bucket's range of buckets) and is written
in that order. A task holds its bucket's numbers, 4 bytes each; rows are sorted into place, which spills.

Buckets follow each other, so a record's position in the whole is its bucket's start and its place there, and shard k of s takes
the positions from k * n / s to (k + 1) * n / s: law ``rows``, shards differ by one record at most. Slots count from 0 in each
shard. A shard is a folder of files, one for each bucket that reaches into it, each in order of slot.

A record's size is the UTF-8 bytes of its text and 16; null texts have none. All columns are carried as one struct, so they may
have any name and hold nulls; texts of any length stay whole. Records have no ties, as places differ: repeated rows are records
of their own. Without records there are no files. The first pass is the only one that reads ``docs``; what lies in which place
is fixed once it's written, so lost executors change nothing later, and reruns over the same staged records agree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, remove, staged_at, text_of


@dataclass(frozen=True)
class Layout:
    shards: int = 40
    seed: int = 42
    bucket_bytes: int = 8 << 20
    most_buckets: int = 1 << 16


#: Buckets whose shuffles one task draws, one after the other.
DRAWN = 64


def size_of(text: str | Column) -> Column:
    return (F.octet_length(text_of(text)) + 16).cast("long")


def scattered(docs: DataFrame, layout: Layout, text: str = "text") -> tuple[DataFrame, str, int]:
    """The first pass: records (bucket, place, row) as written, where they lie, and how many buckets there are."""
    records = docs.select(F.monotonically_increasing_id().alias("place"), size_of(text).alias("size"), F.struct("*").alias("row"))
    written, path = staged_at(records, "shuffle-records", compression="zstd")
    total = written.agg(F.sum("size")).first()[0] or 0
    n_buckets = max(1, min(layout.most_buckets, -(-total // layout.bucket_bytes)))
    bucket = F.pmod(F.xxhash64(F.lit(layout.seed), "place"), F.lit(n_buckets)).cast("int")
    return written.select(bucket.alias("bucket"), "place", "row"), path, n_buckets


def drawn(records: DataFrame, n_buckets: int, layout: Layout) -> DataFrame:
    """Per bucket that has records: its start among all, the number of all records, and a Fisher-Yates shuffle of its numbers.

    Counts have a row for each bucket, ``most_buckets`` at most; that bounds the window and what is broadcast.
    """
    counts = records.groupBy("bucket").agg(F.count("*").cast("int").alias("rows"))
    before, everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    counts = counts.select("bucket", "rows", F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long").alias("start"), F.sum("rows").over(everything).cast("long").alias("n"))
    # Draws follow the number of the range's task, so the numbers of buckets are dealt as a range and never shuffled before they are drawn for.
    numbers = records.sparkSession.range(0, n_buckets, 1, -(-n_buckets // DRAWN)).select(F.col("id").cast("int").alias("bucket"))
    return numbers.join(F.broadcast(counts), "bucket").select("bucket", "start", "n", F.shuffle(F.sequence(F.lit(0), F.col("rows") - 1), layout.seed).alias("order"))


def write_shards(docs: DataFrame, layout: Layout = Layout(), path: str | None = None, text: str = "text") -> str:
    """Shuffle ``docs`` into shards under ``path`` (by default a new one in the shared folder) and return it."""
    records, staged_path, n_buckets = scattered(docs, layout, text)
    order, order_path = staged_at(drawn(records, n_buckets, layout), "shuffle-order")
    path = path or new_path(docs.sparkSession, "shuffled-shards")
    numbered = records.repartitionById(n_buckets, F.col("bucket")).withColumn("number", F.row_number().over(Window.partitionBy("bucket").orderBy("place")))
    # Both sides lie by bucket already, and a bucket's shuffle is a row: the merge moves nothing, and never holds more than one.
    placed = numbered.join(order.repartitionById(n_buckets, F.col("bucket")).hint("merge"), "bucket")
    placed = placed.select((F.col("start") + F.element_at("order", F.col("number"))).alias("position"), "n", "row")
    s = int(layout.shards)
    # A shard begins at the first position p with p * s >= shard * n.
    placed = placed.withColumn("shard", F.expr(f"cast(position * {s} div n as int)")).withColumn("slot", F.expr(f"position - (shard * n + {s} - 1) div {s}"))
    placed.select("shard", "slot", "row").sortWithinPartitions("shard", "slot").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    for spent in (staged_path, order_path):
        remove(docs.sparkSession, spent)
    return path


def read_shards(spark: SparkSession, path: str, row_schema, shards: list[int] | None = None) -> DataFrame:
    """The rows (shard, slot, row) of all shards or of those named; ``row_schema`` is that of the documents."""
    schema = f"slot long, row {row_schema.simpleString()}, shard int"
    found = spark.read.schema(schema).parquet(path)
    return found if shards is None else found.where(F.col("shard").isin(shards))


def report(docs: DataFrame, layout: Layout = Layout(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per record, read back from the shards: ``key``, size, text_crc32, law, shard, slot and grown_shard (null under this law)."""
    rows = read_shards(docs.sparkSession, write_shards(docs, layout, text=text), docs.schema)
    said = F.col("row").getField(text)
    return rows.select(
        F.col("row").getField(key).alias(key), size_of(said).alias("size"), F.crc32(text_of(said)).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
