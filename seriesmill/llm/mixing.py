"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a keyed hash, once per pass over the source; a document's virtual finish time
is its source's words up to and including it, divided by the source's target. The mix is all documents by finish
time, cut at the total budget, so every source has run through the same share of its target wherever the mix is cut.

Shuffled documents are numbered without ever gathering a source: they are cut into buckets by the hash, bucket sums
give each bucket its start, and only a bucket is summed row by row. Buckets hold about ``bucket_rows`` rows for a
source of any size: where more rows than that share a doc_id in a source (or have none), their size and row number salt
the hash. The global cut is found the same way: sums by bin of finish time, sums by part of one bin, then
that part's rows, about one in ``bins`` squared.

Null texts have size 0, null sources are a source of their own (last by code point), null doc_ids hash as their own
word; rows with equal doc_ids in a source are put in order of size, unless salted. Texts of any length are counted whole.
Documents without words take nothing. An empty table, or one without words, gives targets of 0. Only doc_id, source and
text are read for the plan, so other columns may have any name; the mix carries rows as one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, remove, staged, staged_at, text_of


@dataclass(frozen=True)
class Mix:
    """weights are dealt to sources by code point, in turn; share is the budget over all sizes; most the cap over a source's size."""

    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: float = 2.0
    seed: str = "mix"
    bucket_rows: int = 4_096
    bins: int = 65_536


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """Per source: its number, rows, size and target; ``sizes(source, rows, source_size)`` has a row per source.

    The excess of capped sources is dealt out again by weight until no target is above its cap: sources are taken by
    cap / weight, and one is capped if the level of those from it on (what is left, over their weights) reaches that.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    w = sizes.withColumn("rank", F.row_number().over(place) - 1)
    w = w.withColumn("weight", F.element_at(weights, F.pmod("rank", F.lit(len(mix.weights))) + 1))
    w = w.withColumn("cap", F.lit(mix.most) * F.col("source_size"))
    everything, by_level = Window.partitionBy(), Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, onward = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    w = w.withColumn("budget", F.lit(mix.share) * F.sum("source_size").over(everything))
    w = w.withColumn("level", (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    w = w.withColumn("open", F.col("cap") / F.col("weight") > F.col("level"))
    w = w.withColumn("final", F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("open"), F.col("final") * F.col("weight")).otherwise(F.col("cap"))
    return w.select("source", "rank", "rows", "source_size", "budget", target.alias("target"))


def salted(rows: DataFrame, mix: Mix) -> DataFrame:
    """``rows`` with ``salt``: empty, but for rows of ids that have more than ``bucket_rows`` rows in a source."""
    id, named = F.coalesce(F.col("id").cast("string"), F.lit("null")), F.coalesce("source", F.lit(""))
    many = rows.groupBy(id.alias("many_id"), "has", named.alias("many_named")).count().where(F.col("count") > mix.bucket_rows)
    many = many.select("many_id", F.col("has").alias("many_has"), "many_named", F.ceil(F.col("count") / mix.bucket_rows).alias("parts"))
    found = rows.join(staged(many, "many-rows"), (id == F.col("many_id")) & (F.col("has") == F.col("many_has")) & (named == F.col("many_named")), "left")
    salt = F.concat(F.lit(":"), F.col("size"), F.lit(":"), F.pmod(F.xxhash64("at"), F.col("parts")))
    return found.withColumn("salt", F.coalesce(salt, F.lit(""))).drop("many_id", "many_has", "many_named", "parts")


def ordered(rows: DataFrame, mix: Mix) -> tuple[DataFrame, str]:
    """``rows(id, at, source, size)`` with source_size, target and each pass's key and finish time; and a staged path that these need."""
    sizes = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    wanted = targets(sizes, mix)
    out = salted(rows.withColumn("has", F.col("source").isNotNull()), mix).withColumn("named", F.coalesce("source", F.lit("")))
    small = wanted.withColumn("has", F.col("source").isNotNull()).withColumn("named", F.coalesce("source", F.lit(""))).drop("source")
    out = out.join(small, ["has", "named"])
    for p in range(1, int(-(-mix.most // 1)) + 1):
        key = F.md5(F.concat(F.lit(f"{mix.seed}:{p}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("salt")))
        # The first 8 hex digits as a share of their range say which bucket; nb grows with the source.
        share = F.conv(F.substring(F.col(f"key{p}"), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
        out = out.withColumn(f"key{p}", key).withColumn(f"bucket{p}", F.floor(share * F.ceil(F.col("rows") / mix.bucket_rows)).cast("long"))
    out, path = staged_at(out.drop("has", "named", "salt"), "mix-keys")
    for p in range(1, int(-(-mix.most // 1)) + 1):
        bucket = f"bucket{p}"
        sums = out.groupBy("rank", bucket).agg(F.sum("size").alias("words"))
        earlier = Window.partitionBy("rank").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("rank", bucket, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start"))
        inside = Window.partitionBy("rank", bucket).orderBy(f"key{p}", "size").rowsBetween(Window.unboundedPreceding, 0)
        done = F.col("start") + F.sum("size").over(inside) + (p - 1) * F.col("source_size")
        out = out.join(sums, ["rank", bucket]).withColumn(f"finish{p}", F.when(F.col("target") > 0, done / F.col("target"))).drop("start", bucket)
    return out, path


def crossing(rows: DataFrame, by: str) -> DataFrame:
    """(by, start) of ``rows(by, words, budget, start)``: the bin whose words, on top of ``start``, first exceed the budget, and what lies before it. A row at most."""
    up_to = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    sums = rows.groupBy(by).agg(F.sum("words").alias("words"), F.max("budget").alias("budget"), F.max("start").alias("start"))
    done = sums.withColumn("done", F.col("start") + F.sum("words").over(up_to)).where("done > budget")
    return done.agg(F.min_by(F.struct(by, (F.col("done") - F.col("words")).alias("start")), by).alias("x")).select("x.*").where(F.col(by).isNotNull())


def mixed(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``rows(id, at, source, size)`` with source_size, target, copies (passes that take the row) and finish times; ``at`` numbers the rows."""
    passes = range(1, int(-(-mix.most // 1)) + 1)
    found, path = ordered(rows, mix)
    out = staged(found, "mix-order")
    remove(rows.sparkSession, path)
    place = lambda p: F.struct(F.col(f"finish{p}").alias("finish"), F.col("rank"), F.lit(p).alias("pass"), F.col(f"key{p}").alias("key"), F.col("size"))
    all_passes = out.select(F.inline(F.array(*[F.struct(place(p).alias("place"), F.col("size").alias("words"), F.col("budget")) for p in passes]))).where("place.finish is not null and words > 0")
    # Finish times are cut into bins, and the bin of the cut into bins again: windows go over sums of bins, and over the rows of one bin of bins.
    scale = F.least(F.col("place.finish"), F.lit(4.0)) * mix.bins / 4
    binned = all_passes.withColumn("bin", F.floor(scale).cast("long")).withColumn("part", F.floor((scale - F.col("bin")) * mix.bins).cast("long"))
    near = binned.join(F.broadcast(crossing(binned.withColumn("start", F.lit(0).cast("long")), "bin")), "bin")
    near = near.join(F.broadcast(crossing(near, "part").withColumnRenamed("start", "begins")), "part")
    inside = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("done", F.col("begins") + F.sum("words").over(inside))
    # A row without words takes the mix's place of its finish time, too.
    first_out = near.where("done > budget").agg(F.min("place").alias("cut"))
    taken = lambda p: F.when(F.col(f"finish{p}").isNotNull() & (F.col("cut").isNull() | (place(p) < F.col("cut"))), 1).otherwise(0)
    return out.crossJoin(F.broadcast(first_out)).withColumn("copies", sum((taken(p) for p in passes), F.lit(0))).drop("cut")


def plan(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target and taken (words the mix takes, repeats counted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("at"), F.col("source").cast("string").alias("source"), n_words(text_of("text")).alias("size"))
    return mixed(rows, mix).select(F.col("id").alias("doc_id"), "size", "source_size", F.col("target").cast("double").alias("target"), (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself: rows of ``docs``, one for each time they are taken, range-sorted by finish time."""
    whole = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")), "mix-rows")
    # Ties and hashes follow doc_id, so reruns agree however the rows lie in files; the row number only joins.
    rows = whole.select("row.doc_id", "id", "row.source", n_words(text_of("row.text")).alias("size"))
    rows = rows.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), F.col("id").alias("at"), F.col("source").cast("string").alias("source"), "size")
    passes = range(1, int(-(-mix.most // 1)) + 1)
    picked = mixed(rows, mix).where("copies > 0").select("at", F.explode(F.slice(F.array_sort(F.array(*[f"finish{p}" for p in passes])), 1, F.col("copies"))).alias("finish"))
    return whole.join(picked, whole["id"] == picked["at"]).repartitionByRange("finish", "at").sortWithinPartitions("finish", "at").select("row.*")
