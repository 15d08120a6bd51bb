"""Shuffled shards: the law, whole records, and the shuffle itself drawn again step by step."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from seriesmill.llm import shuffle_shards
from seriesmill.llm.queries import QUERIES
from seriesmill.llm.shuffle_shards import Layout, read_shards, report, write_shards

from ..oracle import SF


class Twister:
    """The generator behind ``shuffle``: MT19937 seeded by the two halves of a long, whole numbers below a bound by 31 bits."""

    def __init__(self, seed: int):
        self.source = np.random.RandomState([seed >> 32 & 0xFFFFFFFF, seed & 0xFFFFFFFF])

    def below(self, n: int) -> int:
        while True:
            bits = int.from_bytes(self.source.bytes(4), "little") >> 1
            if n & -n == n:
                return n * bits >> 31
            if bits - bits % n + n - 1 < 1 << 31:
                return bits % n


def fisher_yates(n: int, random: Twister) -> list[int]:
    out = [0] * n
    for i in range(n):
        j = random.below(i + 1)
        out[i] = out[j]
        out[j] = i
    return out


def law_holds(rows: list, shards: int) -> None:
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[k]) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows) and set(slots) <= set(range(shards))


def test_query(spark):
    rows = QUERIES["op11_sharding"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    law_holds(rows, 40)
    wanted = sorted((d["doc_id"], len((d["text"] or "").encode()) + 16, zlib.crc32((d["text"] or "").encode())) for d in docs)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == wanted
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    # Shuffled: hardly a record keeps its place, and neighbours part.
    at = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    order = [d for d, _ in sorted(at.items(), key=lambda x: x[1])]
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < len(order) / 10


def test_the_shuffle_is_fisher_yates_bucket_by_bucket(spark):
    layout = Layout(shards=7, bucket_bytes=200_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    places = [r["doc_id"] for r in docs.collect()]  # one partition: places count from 0
    total = sum(r["n"] for r in docs.select(shuffle_shards.size_of("text").alias("n")).collect())
    n_buckets = -(-total // layout.bucket_bytes)
    assert 2 < n_buckets <= shuffle_shards.DRAWN
    buckets = defaultdict(list)
    for place, doc_id in enumerate(places):
        # Spark's hash of several columns: each is hashed with the last one's hash as its seed.
        h = xxhash.xxh64_intdigest(place.to_bytes(8, "little"), spark_int(layout.seed))
        buckets[(h - (1 << 64) if h >> 63 else h) % n_buckets].append(doc_id)
    random, order = Twister(layout.seed), []
    for b in sorted(buckets):
        drawn = fisher_yates(len(buckets[b]), random)
        at = sorted(range(len(drawn)), key=lambda i: drawn[i])
        order += [buckets[b][i] for i in at]
    found = read_shards(spark, write_shards(docs, layout), docs.schema).orderBy("shard", "slot").select("row.doc_id").collect()
    assert [r["doc_id"] for r in found] == order


def spark_int(value: int) -> int:
    """XXH64 of an int with seed 42, as ``xxhash64`` chains it."""
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), 42)


@pytest.mark.parametrize("n", [0, 1, 3, 7, 100])
def test_edges(spark, n):
    rows = [(None if i % 3 else 5, None if i % 5 == 0 else "é" * (i % 4), "x", i) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")
    found = report(docs, Layout(shards=7, bucket_bytes=100)).collect()
    law_holds(found, 7)
    key = lambda r: tuple((x is None, x) for x in r)
    wanted = [(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _, _ in rows]
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in found), key=key) == sorted(wanted, key=key)


def test_equal_rows_scatter_and_shards_are_files_in_order(spark, tmp_path):
    docs = spark.createDataFrame([(1, "same text")], "doc_id long, text string").crossJoin(spark.range(3_000)).drop("id")
    layout = Layout(shards=4, bucket_bytes=2_500)
    counts = [r["count"] for r in shuffle_shards.scattered(docs, layout)[0].groupBy("bucket").count().collect()]
    assert len(counts) == 30 and max(counts) < 2 * min(counts)
    path = write_shards(docs, layout, str(tmp_path / "shards"))
    law_holds(read_shards(spark, path, docs.schema).collect(), 4)
    one = read_shards(spark, path, docs.schema, [2])
    assert {r["shard"] for r in one.collect()} == {2}
    of_file = [r["s"] for r in one.groupBy(F.input_file_name()).agg(F.collect_list("slot").alias("s")).collect()]
    assert all(s == list(range(s[0], s[0] + len(s))) for s in of_file)


def test_no_python_on_the_main_path(spark, capsys):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    records, _, n = shuffle_shards.scattered(docs, Layout())
    shuffle_shards.drawn(records, n, Layout()).explain()
    report(docs).explain()
    said = capsys.readouterr().out
    assert not any(x in said for x in ("Arrow", "Pandas", "BatchEvalPython"))


def test_same_seed_same_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a, b, c = (sorted(map(tuple, report(docs, Layout(seed=s)).select("doc_id", "shard", "slot").collect())) for s in (1, 1, 2))
    assert a == b != c
