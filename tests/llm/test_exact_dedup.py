"""The extendible-hash index: equal texts, split buckets, colliding hashes, hot keys at several owners."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from seriesmill.llm import exact_dedup


def plain(rows):
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for id, text in rows:
        groups.setdefault(lower(text), []).append(id)
    return sorted((str(id), str(max((x for x in groups[lower(t)] if x is not None), default=None)), len(groups[lower(t)])) for id, t in rows)


ROWS = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, " ab"), (None, "ab"), (None, "zz"), (8, "x" * 100_000), (9, "X" * 100_000), (9, "twin"), (9, "twin")]


@pytest.mark.parametrize("capacity", [None, 1, 50, 10**9])
def test_groups(spark, capacity):
    docs = spark.createDataFrame([(i, t, 0, "n") for i, t in ROWS], "doc_id long, text string, hash int, `row` string").repartition(3)
    found = exact_dedup.deduplicate(docs, capacity=capacity).collect()
    assert sorted((str(r.id), str(r.keep), r.size) for r in found) == plain(ROWS)
    assert sum(r.kept for r in found) == len({t for _, t in [(i, (t or "").lower() if (t or "").isascii() else t) for i, t in ROWS]})
    assert all(r.id == r.keep for r in found if r.kept)
    left = exact_dedup.drop_duplicates(docs, capacity=capacity)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in found)


def test_report(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    found = exact_dedup.report(docs).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in found) == plain(ROWS)
    assert {r.text_sha256 for r in found if r.doc_id in (1, 2)} == {hashlib.sha256(b"ab").hexdigest()}
    assert {r.text_sha256 for r in found if r.doc_id in (3, 4)} == {hashlib.sha256(b"").hexdigest()}


def test_capacity_changes_owners_and_not_the_result(spark):
    """One key has over a third of the rows, and another colliding one is found by its bytes."""
    rows = [(i, "Hot" if i % 5 < 2 else f"text {i % 229} " * (i % 7)) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)

    def owners(capacity):
        pages, _ = exact_dedup.dealt(docs, "doc_id", "text", capacity)
        return pages.groupBy("owner", F.lower(F.col("body").cast("string")).alias("norm")).agg(F.count("*").alias("n"), F.max("hot").alias("hot")).collect()

    wide, narrow = owners(10**9), owners(200)
    assert {r.owner for r in wide if r.norm == "hot"} != {r.owner for r in narrow if r.norm == "hot"}
    assert not any(r.hot for r in wide) and len({r.owner for r in narrow if r.norm == "hot" and r.hot}) > 1
    assert max(r.n for r in narrow if r.norm == "hot") < 1_200
    for capacity in (10**9, 200):
        got = exact_dedup.deduplicate(docs, capacity=capacity).collect()
        assert sorted((str(r.id), str(r.keep), r.size) for r in got) == plain(rows)
        assert sum(r.kept for r in got) == len({t.lower() for _, t in rows}) == exact_dedup.drop_duplicates(docs, capacity=capacity).count()


def test_keys_fold_more_than_the_result(spark):
    rows = [(1, "É"), (2, "é"), (3, "ÉA"), (4, "Éa"), (5, "İ"), (6, "i̇"), (7, "ΑΣ"), (8, "ας")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert docs.select(exact_dedup.key_of(F.col("text")).alias("h")).distinct().count() < 7
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in exact_dedup.report(docs).collect()) == plain(rows)


def test_chains_compare_bytes():
    heads = exact_dedup.chained(list(range(6)), [4, None, 9, 1, 9, 2], [7, 7, 7, 7, 7, 8], [True] * 5 + [False], [b"a", b"b", b"a", b"c", b"a", b"a"])
    assert [(h.text, h.at, h.keep, h.keep_at, h.size) for h in heads] == [(b"a", 0, 9, 4, 3), (b"b", 1, None, 1, 1), (b"a", 0, 9, 4, 3), (b"c", 3, 1, 3, 1), (b"a", 0, 9, 4, 3), (None, 5, 2, 5, 1)]


@pytest.mark.parametrize("seed", range(6))
def test_runs_end_with_their_key(monkeypatch, seed):
    """However rows are cut into batches; only a hot key is cut, at HELD rows."""
    monkeypatch.setattr(exact_dedup, "HELD", 4)
    rng = random.Random(seed)
    rows = sorted((rng.randint(0, 6), i) for i in range(rng.randint(0, 60)))
    cuts = [0, *sorted(rng.randint(0, len(rows)) for _ in range(9)), len(rows)]
    batch = lambda part: pa.RecordBatch.from_pydict({"at": [i for _, i in part], "id": [i for _, i in part], "hash": pa.array([h for h, _ in part], pa.int64()), "hot": pa.array([h == 3 for h, _ in part], pa.bool_())})
    got = [[r for b in held for r in b.to_pylist()] for held in exact_dedup.runs(iter([batch(rows[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]))]
    assert [(r["hash"], r["at"]) for b in got for r in b] == rows
    for h in {h for h, _ in rows} - {3}:
        assert sum(any(r["hash"] == h for r in b) for b in got) == 1


def test_directory_doubles_only_where_needed():
    fills = lambda given, n=16: np.array([given.get(i, 0) for i in range(n)])
    assert exact_dedup.buckets(fills({}), 10) == (0, [0])
    bits, cells = exact_dedup.buckets(fills({0: 30, 1: 30, 15: 5}), 40)
    assert bits == 4 and cells[0] == 0 and cells[1] == 1 and cells[8] == cells[15] == 8
    bits, cells = exact_dedup.buckets(fills({0: 1000}), 40)
    assert bits == 4 and len(cells) == 16


def test_owners_have_ranges_of_buckets():
    fills = np.ones(64, dtype=np.int64)
    d = exact_dedup.directory(fills, 4, 5)
    assert d.owners == sorted(d.owners) and set(d.owners) == set(range(5))
    assert all(len({o for o, b in zip(d.owners, d.buckets) if b == x}) == 1 for x in d.buckets)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.report(docs).count() == 0 and exact_dedup.drop_duplicates(docs).count() == 0
