"""Exact deduplication by an extendible-hash index on shared files.

Keys are 64-bit hashes that equal texts share. The directory has a cell for each prefix of the key; it doubles (cells take
one more bit) while some bucket holds more than ``capacity`` bytes of text, and an overfull bucket is split between the
two halves of its cells. Its size is bounded: the capacity grows with the table where none is given, so that there are
about EACH buckets to an owner, and there are MOST_OWNERS owners at most. Buckets are dealt to owner tasks by the
directory, in ranges of keys and of about the same number of bytes; nothing is sampled or sorted over tasks.

An owner gets its rows in order of key and chains: a key's texts are compared by their bytes with the heads of the
key's chain, and a text that equals none becomes a further head. What it finds goes to shared files with the rows, and is
read from there. A key whose rows hold more than ``capacity`` bytes is hot, and no directory can split it: its rows are
dealt by row number to as many owners as it fills buckets, and the heads that these find are merged by key and text in a second,
small step. So one key may hold any share of the rows.

Two texts are equal when they are identical after lower-casing A-Z; null counts as empty. Texts of any length are compared
whole. The row with the largest doc_id stays (null doc_ids come last; of rows with equal doc_ids one stays, fixed when the
index is written). An empty table gives an empty result. Other columns may have any name: rows are carried as one struct.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, remove, staged, staged_at, text_of

#: Bytes of text for an owner where the table has more than the shuffle's tasks would hold, owners at most, and buckets of each.
OWNER_BYTES, MOST_OWNERS, EACH = 256 << 20, 1 << 16, 8
#: Rows of one hot key, and bytes of them, that are chained together.
HELD, HELD_BYTES = 65_536, 32 << 20


def key_of(text: Column) -> Column:
    """A hash that texts share if they are equal after lower-casing A-Z; ``lower`` folds more letters, and the bytes tell those apart."""
    return F.xxhash64(F.lower(text))


@dataclass(frozen=True)
class Directory:
    """The owner of each cell of ``bits`` bits, and how many owners there are."""

    bits: int
    buckets: list[int]
    owners: list[int]
    n_owners: int


def buckets(fills: np.ndarray, capacity: int) -> tuple[int, list[int]]:
    """Bits of the directory and each cell's bucket, for the bytes that have each prefix of log2(len(fills)) bits.

    It starts with one cell and one bucket. A bucket over ``capacity`` is split by its next bit; if its cells are already
    of that many bits, the directory doubles first. A bucket is named by its first prefix.
    """
    most_bits = len(fills).bit_length() - 1
    total = np.concatenate([[0], np.cumsum(fills)])
    bits, leaves, open_ = 0, [], [(0, 0)]
    while open_:
        prefix, depth = open_.pop()
        lo, hi = prefix << (most_bits - depth), (prefix + 1) << (most_bits - depth)
        if total[hi] - total[lo] > capacity and depth < most_bits:
            bits = max(bits, depth + 1)
            open_ += [(2 * prefix + 1, depth + 1), (2 * prefix, depth + 1)]
        else:
            leaves.append((lo, hi))
    cells = np.zeros(len(fills), dtype=np.int64)
    for lo, hi in leaves:
        cells[lo:hi] = lo
    return bits, cells[:: 1 << (most_bits - bits)].tolist()


def directory(fills: np.ndarray, capacity: int, n_owners: int) -> Directory:
    """The directory for these fills, its buckets dealt to owners in ranges of about the same number of bytes."""
    bits, cells = buckets(fills, capacity)
    upto = np.concatenate([[0], np.cumsum(fills)])
    share = upto[cells] / max(1, upto[-1])
    return Directory(bits, cells, np.minimum((share * n_owners).astype(int), n_owners - 1).tolist(), n_owners)


def prefix(bits: int) -> Column:
    return F.shiftrightunsigned("hash", 64 - bits) if bits else F.lit(0).cast("long")


def dealt(docs: DataFrame, key: str, text: str, capacity: int | None) -> tuple[DataFrame, list[str]]:
    """Rows with their number, id, hash and whether the key is hot, at their owners, in order of hash; and the staged paths that these need."""
    body = text_of(text)
    keys, keys_path = staged_at(docs.select(key_of(body).alias("hash"), (F.octet_length(body) + 1).cast("long").alias("bytes")), "hash-keys")
    total = keys.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    n_owners = min(MOST_OWNERS, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // OWNER_BYTES)))
    capacity = max(capacity or total // (EACH * n_owners), total // (EACH * MOST_OWNERS), 1)
    most_bits = min(21, 3 + math.ceil(math.log2(max(1, total / capacity))))
    cells = keys.withColumn("cell", prefix(most_bits))
    found = cells.groupBy("cell").agg(F.sum("bytes").alias("bytes")).toArrow()  # a row for each cell
    fills = np.zeros(1 << most_bits, dtype=np.int64)
    fills[found.column("cell").to_numpy()] = found.column("bytes").to_numpy()
    # At most total / capacity keys are hot, EACH * MOST_OWNERS whatever the table; only cells that are themselves overfull can hold one.
    spark = docs.sparkSession
    overfull = spark.createDataFrame(pa.table({"cell": np.flatnonzero(fills > capacity).astype(np.int64)}))
    hot = cells.join(F.broadcast(overfull), "cell").groupBy("hash", "cell").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > capacity)
    hot, hot_path = staged_at(hot, "hot-keys")
    remove(spark, keys_path)
    for cell, n in hot.groupBy("cell").agg(F.sum("bytes")).collect():
        fills[cell] -= n
    d = directory(fills, capacity, n_owners)
    owners = spark.createDataFrame(pa.table({"cell": np.arange(len(d.owners)), "owner": np.array(d.owners, dtype=np.int32)}))
    rows = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("id"), key_of(body).alias("hash"), body.cast("binary").alias("body"), F.monotonically_increasing_id().alias("at"))
    placed = rows.withColumn("cell", prefix(d.bits)).join(F.broadcast(owners), "cell")
    placed = placed.join(F.broadcast(hot.select("hash", F.ceil(F.col("bytes") / capacity).cast("int").alias("parts"))), "hash", "left")
    spread = F.pmod(F.col("owner") + F.pmod(F.xxhash64("at"), F.col("parts")), F.lit(n_owners))
    placed = placed.withColumn("owner", F.coalesce(spread, "owner").cast("int"))
    pages = placed.repartitionById(n_owners, "owner").select("at", "id", "hash", F.col("parts").isNotNull().alias("hot"), "body", "row", "owner")
    return pages.sortWithinPartitions("hash", "at"), [hot_path]


FOUND = {"class": pa.int64(), "keep": pa.int64(), "keep_at": pa.int64(), "size": pa.int64(), "text_sha256": pa.string(), "text": pa.binary()}
FOUND_SCHEMA = "class long, keep long, keep_at long, size long, text_sha256 string, text binary"


@dataclass
class Head:
    """A text that a chain has met, and what is known of the rows that equal it."""

    text: bytes | None
    at: int
    keep: int | None
    keep_at: int
    size: int = 0
    digest: str | None = None

    def add(self, at: int, id: int | None) -> None:
        self.size += 1
        if id is not None and (self.keep is None or id >= self.keep):
            self.keep, self.keep_at = id, at

    def close(self, digest: bool, hot: bool) -> None:
        """No further text is compared with this one; it stays at hand where other owners have heads of its key."""
        self.digest = hashlib.sha256(self.text).hexdigest() if digest else None
        self.text = self.text if hot else None


def chained(ats: Iterable[int], ids: Iterable[int | None], hashes: Iterable[int], hot: Iterable[bool], texts: Iterable[bytes], digest: bool = False) -> list[Head]:
    """The head of each row, rows being in order of hash: a key's chain is searched by comparing bytes."""
    out, links, last, was_hot = [], [], None, False
    for at, id, hash, is_hot, text in zip(ats, ids, hashes, hot, texts, strict=True):
        if hash != last:
            for h in links:
                h.close(digest, was_hot)
            links, last, was_hot = [], hash, is_hot
        head = next((h for h in links if h.text == text), None)
        if head is None:
            head = Head(text, at, id, at)
            links.append(head)
        head.add(at, id)
        out.append(head)
    for h in links:
        h.close(digest, was_hot)
    return out


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Slices of batches, in lists that end where a key ends, but for hot keys, which are cut at HELD rows or HELD_BYTES.

    The rows that are held of other keys are those of the last key of a batch: ``capacity`` bytes at most.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        hashes = b.column(2).to_numpy()
        first = int(np.searchsorted(hashes, hashes[-1]))  # of the last key
        if first:
            yield [*held, b.slice(0, first)]
            held = []
        elif held and held[-1].column(2)[0].as_py() != hashes[-1]:
            yield held
            held = []
        held.append(b.slice(first))
        if b.column(3)[b.num_rows - 1].as_py() and (sum(x.num_rows for x in held) >= HELD or sum(x.nbytes for x in held) >= HELD_BYTES):
            yield held
            held = []
    if held:
        yield held


def owned(pages: DataFrame, rows: bool, text: str = "text") -> DataFrame:
    """What owners find: per row its class (the row number of the chain's head), keep, keep_at and size, final for keys that aren't hot.

    Rows that head a chain of a hot key come with their text. With ``rows``, only those that stay, or may stay, come, with
    the row itself, and its column ``text`` is compared.
    """

    def work(batches: Iterator[pa.RecordBatch]):
        for held in runs(batches):
            body = [(b.column(4).field(text) if rows else b.column(4)).cast(pa.binary()) for b in held]
            texts = ((t.as_py() or b"").lower() for column in body for t in column)  # of bytes: A-Z only
            listed = lambda k: chain.from_iterable(b.column(k).to_pylist() for b in held)  # noqa: B023, E731
            heads = chained(listed(0), listed(1), listed(2), listed(3), texts, digest=not rows)
            for b in held:
                own, heads = heads[: b.num_rows], heads[b.num_rows :]
                ats, hot = b.column(0).to_pylist(), b.column(3).to_pylist()
                if rows:
                    stay = pa.array([at == h.keep_at for at, h in zip(ats, own)], pa.bool_())
                    b, own = b.filter(stay), [h for at, h in zip(ats, own) if at == h.keep_at]
                    ats, hot = b.column(0).to_pylist(), b.column(3).to_pylist()
                found = [(h.at, h.keep, h.keep_at, h.size, h.digest, h.text if is_hot and at == (h.keep_at if rows else h.at) else None) for at, is_hot, h in zip(ats, hot, own)]
                columns = [pa.array(c, k) for c, k in zip(zip(*found), FOUND.values())] if found else [pa.array([], k) for k in FOUND.values()]
                yield pa.RecordBatch.from_arrays([*b.columns[: 5 if rows else 4], *columns], names=[*b.schema.names[: 5 if rows else 4], *FOUND])

    taken = pages.select("at", "id", "hash", "hot", "row" if rows else "body")
    kinds = [f for f in taken.schema if f.name != "body"]
    return taken.mapInArrow(frugal(work), T.StructType([*kinds, *T._parse_datatype_string(FOUND_SCHEMA).fields]))


def index(docs: DataFrame, key: str, text: str, capacity: int | None, rows: bool) -> DataFrame:
    """What the owners found, on shared files."""
    pages, paths = dealt(docs, key, text, capacity)
    met = staged(owned(pages, rows, text), "hash-index")
    for path in paths:
        remove(docs.sparkSession, path)
    return met


def merged(heads: DataFrame) -> DataFrame:
    """Per text of hot keys, from the heads of all owners: best (keep and keep_at) and total."""
    best = F.max(F.struct(F.col("keep").isNotNull(), "keep", "keep_at"))
    return heads.groupBy("hash", "text").agg(best.alias("best"), F.sum("size").alias("total"))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int | None = None) -> DataFrame:
    """Per row of ``docs``: at (its number), id, keep (the id that stays), size, kept and text_sha256."""
    met = index(docs, key, text, capacity, rows=False)
    heads = met.where("hot and text is not null").select("class", "hash", "text", "keep", "keep_at", "size")
    of_head = heads.join(merged(heads), ["hash", "text"]).select("class", "best", "total")
    parts = met.where("hot").select("at", "id", "class", "text_sha256").join(of_head, "class")
    parts = parts.select("at", "id", F.col("best.keep").alias("keep"), F.col("best.keep_at").alias("keep_at"), F.col("total").alias("size"), "text_sha256")
    found = met.where("not hot").select("at", "id", "keep", "keep_at", "size", "text_sha256").union(parts)
    return found.select("at", "id", "keep", "size", (F.col("at") == F.col("keep_at")).alias("kept"), "text_sha256")


def report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256."""
    return deduplicate(docs).select(F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int | None = None) -> DataFrame:
    """``docs`` with one row of each class of equal texts."""
    met = index(docs, key, text, capacity, rows=True)
    able = met.where("hot")
    stays = able.join(merged(able).select("best.keep_at"), "keep_at", "left_semi")
    return met.where("not hot").select("row.*").union(stays.select("row.*"))
