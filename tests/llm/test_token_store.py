"""Shards in training order: a permutation, and every document's ids at their slots."""

import numpy as np
import public_tokenizers
import pytest
from seriesmill.llm import piece_codec, token_store

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("total", [1, 2, 3, 5, 64, 65, 1000, 4097])
def test_slots_are_a_permutation(total):
    got = token_store.slots(np.arange(total), total, 5, 6)
    assert sorted(got.tolist()) == list(range(total))
    if total > 60:
        assert (got != np.arange(total)).mean() > 0.9
        assert (got != token_store.slots(np.arange(total), total, 6, 6)).mean() > 0.9


def test_round_trip(spark, tmp_path):
    layout = token_store.Layout(length=64, shard_rows=16)
    texts = ["", None, "one two", "long " * 700, *(f"doc {i} " * (i % 50) for i in range(60)), "same", "same"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").coalesce(1)
    index = token_store.materialise(docs, MODEL, str(tmp_path), layout).collect()
    library = piece_codec.processor(MODEL)
    stream = [i for t in texts for i in library.encode(t or "", add_eos=True)]
    sequences = -(-len(stream) // layout.length)
    stream += [library.eos_id()] * (sequences * layout.length - len(stream))
    assert sorted(r.slot for r in index) == list(range(sequences)) and sorted(r.sequence for r in index) == list(range(sequences))
    rows = list(token_store.read_slots(str(tmp_path), 0, sequences, layout))
    for r in index:
        assert rows[r.slot].tolist() == stream[r.sequence * layout.length : (r.sequence + 1) * layout.length]
        assert r.shard == r.slot // layout.shard_rows
    assert {d for r in index for d in r.doc_ids} == set(range(len(texts)))
    files = sorted(p.name for p in tmp_path.iterdir())
    assert files == [token_store.shard_name(i) for i in range(-(-sequences // layout.shard_rows))]
    resumed = list(token_store.read_slots(str(tmp_path), 20, 40, layout))
    assert all((a == b).all() for a, b in zip(resumed, rows[20:40]))


def test_several_encoding_tasks_and_a_second_run(spark, tmp_path):
    """Offsets over encoding tasks, null and repeated doc_ids, and files that are there already."""
    layout = token_store.Layout(length=32, shard_rows=8)
    rows = [(None if i % 11 == 0 else i % 40, f"text {i} " * (i % 23)) for i in range(200)] + [(1, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).cache()
    library = piece_codec.processor(MODEL)
    stream = [i for r in docs.collect() for i in library.encode(r.text or "", add_eos=True)]
    index = token_store.materialise(docs, MODEL, str(tmp_path), layout).collect()
    again = token_store.materialise(docs, MODEL, str(tmp_path), layout).collect()
    assert sorted(map(str, index)) == sorted(map(str, again))
    sequences = -(-len(stream) // layout.length)
    stream += [library.eos_id()] * (sequences * layout.length - len(stream))
    read = list(token_store.read_slots(str(tmp_path), 0, sequences, layout))
    for r in index:
        assert read[r.slot].tolist() == stream[r.sequence * layout.length : (r.sequence + 1) * layout.length]
    assert {d for r in index for d in r.doc_ids} == {d for d, _ in rows}


def test_a_store_that_does_not_rename_onto_a_file(tmp_path):
    from pyarrow import fs

    class Strict:
        def __init__(self, system):
            self.system = system

        def move(self, a, b):
            if self.system.get_file_info(b).type != fs.FileType.NotFound:
                raise OSError("exists")
            self.system.move(a, b)

        def __getattr__(self, name):
            return getattr(self.system, name)

    system = Strict(fs.LocalFileSystem())
    for name, text in (("a", b"one"), ("b", b"one"), ("c", b"longer")):
        (tmp_path / name).write_bytes(text)
    token_store.put(system, f"{tmp_path}/a", f"{tmp_path}/t")
    token_store.put(system, f"{tmp_path}/b", f"{tmp_path}/t")
    assert (tmp_path / "t").read_bytes() == b"one" and not (tmp_path / "b").exists()
    with pytest.raises(OSError):
        token_store.put(system, f"{tmp_path}/c", f"{tmp_path}/t")


def test_sweep(tmp_path):
    for name in (".shard-00000001.bin-x", "shard-00000001.bin"):
        (tmp_path / name).write_bytes(b"x")
    assert token_store.sweep(str(tmp_path)) == 1 and [p.name for p in tmp_path.iterdir()] == ["shard-00000001.bin"]


def test_ids_that_do_not_fit_are_refused(spark, tmp_path):
    token_store.Layout().check(65_536)
    token_store.Layout(id_bytes=4).check(70_000)
    with pytest.raises(ValueError):
        token_store.Layout().check(65_537)
    with pytest.raises(ValueError):
        token_store.materialise(spark.createDataFrame([(1, "x")], "doc_id long, text string"), MODEL, str(tmp_path), token_store.Layout(id_bytes=1))


def test_wide_ids(spark, tmp_path):
    layout = token_store.Layout(length=16, shard_rows=4, id_bytes=4)
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(20)], "doc_id long, text string").coalesce(1)
    index = token_store.materialise(docs, MODEL, str(tmp_path), layout).collect()
    read = list(token_store.read_slots(str(tmp_path), 0, len(index), layout))
    library = piece_codec.processor(MODEL)
    stream = [i for k in range(20) for i in library.encode("some words " * k, add_eos=True)]
    assert [i for r in sorted(index, key=lambda r: r.sequence) for i in read[r.slot].tolist()][: len(stream)] == stream


def test_empty(spark, tmp_path):
    assert token_store.materialise(spark.createDataFrame([], "doc_id long, text string"), MODEL, str(tmp_path)).count() == 0


def test_folders_are_in_the_default_file_system(spark, tmp_path):
    """A path without a scheme isn't each worker's own disk: it is where Spark's own files go."""
    conf = spark._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert token_store.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    try:
        conf.set("fs.defaultFS", "hdfs://127.0.0.1:8020")
        assert token_store.qualified(spark, "/shared/x") == "hdfs://127.0.0.1:8020/shared/x"
        assert token_store.qualified(spark, f"file://{tmp_path}") == f"file://{tmp_path}"
    finally:
        conf.set("fs.defaultFS", before)
    with pytest.raises(ValueError):
        token_store.Layout(id_bytes=3).check(10)
