"""Token ids as binary shards in training order.

Documents are encoded and laid end to end in the order of the input's files; every ``length`` ids are a sequence (the
last is filled up with the end id). A keyed Feistel permutation of the sequence numbers, walked along its cycle until it is
back in range, gives every sequence a global slot without a sort or a table. Slots are cut into shards of ``shard_rows``
sequences; a range of shards goes to each task, which writes them as files of fixed stride: slot s is in file
s // shard_rows at byte (s % shard_rows) * stride. A reader resumes at any slot by a seek. Ids take ``id_bytes`` bytes
each, and a vocabulary that does not fit in them is refused.

Encoded documents are written to the shared folder once, in blocks with their place in their task's stream; a stream's
start is the sum of those before it (a number per task). A shard is written under a name of its own and then renamed, so a
task that runs twice leaves the same whole file, also where the store refuses to rename onto a file that is there.
``sweep`` removes what lost tasks have left. A folder without a scheme is in Spark's default file system, as what Spark itself
writes there; workers reach it by pyarrow, and a file system that it doesn't know is an error.

Null texts count as empty: an end id alone. Texts of any length are laid out whole. Repeated rows are documents of their
own, also with the same or a null doc_id. Without documents there are no sequences and no files. Only doc_id and text
are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, staged, text_of
from .piece_codec import chunk_table, processor, slices


@dataclass(frozen=True)
class Layout:
    length: int = 1_024
    shard_rows: int = 4_096
    key: int = 20_240_229
    rounds: int = 6
    id_bytes: int = 2

    @property
    def stride(self) -> int:
        return self.id_bytes * self.length

    @property
    def id_type(self) -> np.dtype:
        return np.dtype(f"<u{self.id_bytes}")

    def check(self, vocabulary: int) -> None:
        if self.id_bytes not in (1, 2, 4, 8):
            raise ValueError("Layout.id_bytes is 1, 2, 4 or 8")
        if vocabulary > 1 << 8 * self.id_bytes:
            raise ValueError(f"{vocabulary} ids do not fit in {self.id_bytes} bytes each; set Layout.id_bytes")


def feistel(numbers: np.ndarray, bits: int, key: int, rounds: int) -> np.ndarray:
    """A keyed permutation of the numbers of ``bits`` bits (an even count)."""
    half = np.uint64(bits // 2)
    low = (np.uint64(1) << half) - np.uint64(1)
    left, right = numbers.astype(np.uint64) >> half, numbers.astype(np.uint64) & low
    keys = np.frombuffer(hashlib.shake_256(str(key).encode()).digest(8 * rounds), dtype="<u8")
    for k in keys:
        # The round function: splitmix64's finaliser of the half and the round's key.
        x = right ^ k
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & low)
    return left << half | right


def slots(numbers: np.ndarray, total: int, key: int, rounds: int) -> np.ndarray:
    """The slots of sequence numbers below ``total``: a permutation of them all."""
    bits = max(2, (max(total - 1, 1)).bit_length())
    bits += bits % 2
    out = feistel(numbers, bits, key, rounds)
    while (over := out >= total).any():
        out[over] = feistel(out[over], bits, key, rounds)
    return out.astype(np.int64)


def encoded(docs: DataFrame, model: str, layout: Layout = Layout()) -> DataFrame:
    """Blocks of documents: their ids end to end, compressed, and the block's place in the stream of the task that encoded it."""
    kinds = {"part": pa.int64(), "start": pa.int64(), "doc_ids": pa.list_(pa.int64()), "lengths": pa.list_(pa.int64()), "ids": pa.binary()}

    def work(batches: Iterator[pa.RecordBatch]):
        import zstandard
        from pyspark import TaskContext

        part, at, table, end = TaskContext.get().partitionId(), 0, chunk_table(model), [processor(model).eos_id()]
        press = zstandard.ZstdCompressor(level=5)
        for whole in batches:
            for b in slices(whole, 1):
                ids, lengths = table.encode(b.column(1).to_pylist(), end)
                row = (part, at, b.column(0).to_pylist(), lengths, press.compress(ids.astype(layout.id_type).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds.values(), strict=True)], names=list(kinds))
                at += len(ids)

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return wanted.mapInArrow(work, "part long, start long, doc_ids array<long>, lengths array<long>, ids binary")


def pieces(stored: DataFrame, total: int, layout: Layout, end: int) -> DataFrame:
    """Each block's pieces of sequences: slot, sequence, where in the sequence, the documents and the ids, compressed."""
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)
    streams = stored.groupBy("part").agg(F.max(F.col("start") + length).alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = streams.select("part", F.coalesce(before, F.lit(0)).alias("base"))  # a row for each task of the encoding
    placed = stored.join(F.broadcast(bases), "part").select((F.col("base") + F.col("start")).alias("start"), "doc_ids", "lengths", "ids")
    size, sequences = layout.length, -(-total // layout.length)

    def work(batches: Iterator[pa.RecordBatch]):
        import zstandard

        press, unpress = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for b in batches:
            for start, doc_ids, lengths, packed in zip(*(b.column(k).to_pylist() for k in range(4))):
                ids = np.frombuffer(unpress.decompress(packed), dtype=layout.id_type)
                ends = start + np.cumsum(lengths)
                if start + len(ids) == total:
                    ids = np.concatenate([ids, np.full(sequences * size - total, end, dtype=layout.id_type)])
                numbers = np.arange(start // size, (start + len(ids) - 1) // size + 1)
                lo, hi = np.maximum(start, numbers * size), np.minimum(start + len(ids), (numbers + 1) * size)
                # The documents whose ids lie in [lo, hi): from the first that ends behind lo to the first that ends at or behind hi.
                first, last = np.searchsorted(ends, lo, side="right"), np.minimum(np.searchsorted(ends, hi, side="left"), len(ends) - 1)
                first = np.minimum(first, len(ends) - 1)
                data = [press.compress(ids[x:y].tobytes()) for x, y in zip((lo - start).tolist(), (hi - start).tolist())]
                columns = [
                    pa.array(slots(numbers, sequences, layout.key, layout.rounds)), pa.array(numbers), pa.array((lo - numbers * size).astype(np.int32)),
                    pa.array([doc_ids[x : y + 1] for x, y in zip(first.tolist(), last.tolist())], pa.list_(pa.int64())), pa.array(data, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["slot", "sequence", "at", "doc_ids", "ids"])

    return placed.mapInArrow(work, "slot long, sequence long, at int, doc_ids array<long>, ids binary")


def open_folder(path: str):
    """The file system of a folder and the folder's path in it. Without a scheme, which tasks are always given, the session's default file system is asked."""
    from pyarrow import fs

    if ":" not in path.split("/")[0]:
        session = SparkSession.getActiveSession()
        if session is None:
            raise ValueError(f"{path} does not say which file system it is in")
        path = qualified(session, path)
    return fs.FileSystem.from_uri(path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the file system that Spark would take it to be in: without a scheme that is the default one, not each worker's own disk.

    Workers open it by pyarrow, which knows local folders, HDFS (with libhdfs), and object stores as s3, gs or abfss; s3a and s3n are its s3.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()
    scheme, _, rest = whole.partition(":")
    return f"s3:{rest}" if scheme in ("s3a", "s3n") else f"file://{rest}" if scheme == "file" and not rest.startswith("//") else whole


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def put(system, name: str, target: str) -> None:
    """Rename a whole file; where another run of the task has put the same one there, drop this one."""
    try:
        system.move(name, target)
    except OSError:
        there, own = system.get_file_info([target, name])
        if not there.is_file or there.size != own.size:
            raise
        system.delete_file(name)


def sweep(folder: str) -> int:
    """Remove what lost tasks have left in ``folder``, once the job that wrote it has ended; how many files these were."""
    from pyarrow import fs

    system, root = open_folder(folder)
    left = [f.path for f in system.get_file_info(fs.FileSelector(root)) if f.base_name.startswith(".shard-")]
    for path in left:
        system.delete_file(path)
    return len(left)


def materialise(docs: DataFrame, model: str, folder: str, layout: Layout = Layout()) -> DataFrame:
    """Write the shards into ``folder``; per sequence: slot, shard, sequence, doc_ids it holds ids of, and ids_sha256 of its bytes.

    The files are written when the result is.
    """
    layout.check(processor(model).get_piece_size())
    folder = qualified(docs.sparkSession, folder)
    stored = staged(encoded(docs, model, layout), "token-ids")
    total = stored.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x)), F.lit(0))).first()[0]
    rows = pieces(stored, total, layout, processor(model).eos_id()).withColumn("shard", F.floor(F.col("slot") / layout.shard_rows).cast("long"))
    # Slots are dense and even, so the ranges are known: whole shards, the same number to each task, without sampling.
    tasks, shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (layout.length * layout.shard_rows))
    tasks = max(1, min(tasks, shards))
    ranged = rows.repartitionById(tasks, F.floor(F.col("shard") * tasks / max(shards, 1)).cast("int")).sortWithinPartitions("slot", "at")

    def work(batches: Iterator[pa.RecordBatch]):
        import uuid

        import zstandard

        unpress = zstandard.ZstdDecompressor()
        system, root = open_folder(folder)
        system.create_dir(root)
        shard, stream, name, now, done = None, None, None, None, []

        def close_sequence():
            if now:
                data = b"".join(now[3])
                stream.write(data)
                done.append((now[0], now[0] // layout.shard_rows, now[1], now[2], hashlib.sha256(data).hexdigest()))

        def close_shard():
            if stream:
                stream.close()
                put(system, name, f"{root}/{shard_name(shard)}")

        for b in batches:
            for slot, sequence, docs_, packed, of in zip(*(b.column(k).to_pylist() for k in range(5))):
                if not now or slot != now[0]:
                    close_sequence()
                    now = (slot, sequence, [], [])
                    if of != shard:
                        close_shard()
                        shard, name = of, f"{root}/.{shard_name(of)}-{uuid.uuid4().hex}"
                        stream = system.open_output_stream(name)
                now[2].extend(docs_)
                now[3].append(unpress.decompress(packed))
            if done:
                yield listed(done)
                done.clear()
        close_sequence()
        close_shard()
        if done:
            yield listed(done)

    def listed(done: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=["slot", "shard", "sequence", "doc_ids", "ids_sha256"])

    return ranged.select("slot", "sequence", "doc_ids", "ids", "shard").mapInArrow(work, "slot long, shard long, sequence long, doc_ids array<long>, ids_sha256 string")


def read_slots(folder: str, first: int, last: int, layout: Layout = Layout()) -> Iterator[np.ndarray]:
    """The sequences of slots ``first`` up to before ``last``, each read by its place."""
    system, root = open_folder(folder)
    stream, opened = None, None
    for slot in range(first, last):
        if (shard := slot // layout.shard_rows) != opened:
            stream, opened = system.open_input_file(f"{root}/{shard_name(shard)}"), shard
        yield np.frombuffer(stream.read_at(layout.stride, slot % layout.shard_rows * layout.stride), dtype=layout.id_type)


def store(docs: DataFrame, model: str, layout: Layout = Layout()) -> DataFrame:
    """The shards in a new folder of the shared one; its index."""
    return materialise(docs, model, new_path(docs.sparkSession, "shards"), layout)
