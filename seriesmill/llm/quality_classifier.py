"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into chunks that overlap by a filter's width less one, so every window of the whole
document lies in one chunk. Learned filters slide over a chunk, each chunk keeps each filter's largest answer
(rectified), chunks are averaged, and a logistic unit makes one probability of the averages.

It is fitted by one task to a bounded sample: at most ``per_class`` labelled documents of each label, those with the
least hash of their id, and all chunks of their whole texts. Of rows with the same doc_id, the one with the least hash of its
text is learned from. The task sends the model to the driver, and no text. Scoring reads whole texts. Only text enters a
score.

Null and empty texts are scored as a chunk of zero bytes. Rows without a label, with another label than 0 or 1, or
without doc_id are not learned from; a document with several labels counts with each. Without documents of both
labels every score is the share of label 1 (0.5 without any). Equal texts get equal scores. An empty table gives an
empty result. Every other column is passed through; one that has the name of the score is an error.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, text_of


@dataclass(frozen=True)
class Net:
    """Sizes and training parameters; width is even, as scoring looks bytes up in pairs."""

    width: int = 6
    filters: int = 16
    chunk: int = 512
    per_class: int = 1_500
    at_once: int = 1_024
    steps: int = 300
    batch: int = 48
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7

    @property
    def hop(self) -> int:
        return self.chunk - self.width + 1


def chunked(text: bytes, net: Net) -> np.ndarray:
    """The chunks of a text, one per row; the last is padded with zeros."""
    n = max(1, -(-(len(text) - net.width + 1) // net.hop))
    data = np.zeros((n - 1) * net.hop + net.chunk, dtype=np.uint8)
    data[: len(text)] = np.frombuffer(text, dtype=np.uint8)
    return np.lib.stride_tricks.as_strided(data, (n, net.chunk), (net.hop, 1))


@dataclass
class Model:
    """filters: answer of each filter to each byte at each place; a model without filters scores its bias alone."""

    net: Net
    filters: np.ndarray | None
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    @cached_property
    def pairs(self) -> list[np.ndarray]:
        """Answers to two bytes at once, a table for each pair of places."""
        f = self.filters
        return [np.ascontiguousarray((f[j][:, None] + f[j + 1][None] + (self.bias if j == 0 else 0)).reshape(1 << 16, -1), dtype=np.float32) for j in range(0, self.net.width, 2)]


def pooled(chunks: np.ndarray, tables: list[np.ndarray], net: Net) -> np.ndarray:
    """Each filter's largest answer in each chunk, rectified."""
    two = chunks[:, :-1].astype(np.int32) << 8 | chunks[:, 1:]
    total = tables[0][two[:, : net.hop]]
    other = np.empty_like(total)
    for j, table in enumerate(tables[1:], 1):
        np.take(table, two[:, 2 * j : 2 * j + net.hop], axis=0, out=other, mode="clip")
        total += other
    return np.maximum(total.max(axis=1), 0)


def scores(texts: list[bytes], model: Model, at_once: int = 64) -> np.ndarray:
    """A probability for each text; ``at_once`` chunks are worked on together, of one text or several."""
    if model.filters is None:
        return np.full(len(texts), 1 / (1 + np.exp(-model.out_bias)))
    net, tables = model.net, model.pairs
    sums, counts = np.zeros((len(texts), net.filters)), np.zeros(len(texts))
    held, owner, n = [], [], 0

    def flush():
        nonlocal held, owner, n
        if n:
            np.add.at(sums, np.concatenate(owner), pooled(np.concatenate(held), tables, net))
        held, owner, n = [], [], 0

    for i, text in enumerate(texts):
        chunks = chunked(text, net)
        counts[i] = len(chunks)
        for at in range(0, len(chunks), at_once):
            part = chunks[at : at + at_once]
            held.append(part)
            owner.append(np.full(len(part), i))
            n += len(part)
            if n >= at_once:
                flush()
    flush()
    z = sums / counts[:, None] @ model.out + model.out_bias
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def strongest(chunks: np.ndarray, theta: dict[str, np.ndarray], net: Net) -> tuple[np.ndarray, np.ndarray]:
    """Where in each chunk each filter answers most, and that answer."""
    answers = theta["filters"][0][chunks[:, : net.hop]] + theta["bias"]
    for j in range(1, net.width):
        answers += theta["filters"][j][chunks[:, j : j + net.hop]]
    place = answers.argmax(axis=1)
    return place, np.take_along_axis(answers, place[:, None], axis=1)[:, 0]


def fit(samples: list[tuple[bytes, int]], net: Net = Net()) -> Model:
    """Fit to (text, label) pairs by Adam on the log loss; both labels weigh the same. The same samples give the same model."""
    labels = np.array([y for _, y in samples])
    if len(set(labels.tolist())) < 2:
        share = min(max(labels.mean() if len(labels) else 0.5, 0.01), 0.99)
        return Model(net, None, np.zeros(0), np.zeros(0), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(net.seed)
    theta = {
        "filters": rng.normal(0, 0.1, (net.width, 256, net.filters)).astype(np.float32),
        "bias": np.zeros(net.filters, dtype=np.float32),
        "out": rng.normal(0, 0.3, net.filters).astype(np.float32),
        "out_bias": np.zeros(1, dtype=np.float32),
    }
    first, second = ({k: np.zeros_like(v) for k, v in theta.items()} for _ in range(2))
    by_label = [np.flatnonzero(labels == y) for y in (0, 1)]
    for step in range(1, net.steps + 1):
        picked = np.concatenate([rng.choice(x, net.batch // 2) for x in by_label])
        of_each = [chunked(samples[i][0], net) for i in picked]
        chunks = np.concatenate(of_each)
        owner = np.repeat(np.arange(len(picked)), [len(x) for x in of_each])
        share = 1 / np.bincount(owner)[owner]
        place, top = (np.concatenate(x) for x in zip(*(strongest(chunks[at : at + net.at_once], theta, net) for at in range(0, len(chunks), net.at_once))))
        h = np.zeros((len(picked), net.filters))
        np.add.at(h, owner, np.maximum(top, 0) * share[:, None])
        y = labels[picked]
        p = 1 / (1 + np.exp(-np.clip(h @ theta["out"] + theta["out_bias"], -60, 60)))
        dz = (p - y) / len(y)
        dtop = (dz[owner] * share)[:, None] * theta["out"] * (top > 0)
        grad = {"out": h.T @ dz, "out_bias": np.array([dz.sum()]), "bias": dtop.sum(axis=0), "filters": np.zeros_like(theta["filters"])}
        each = np.arange(net.filters)[None]
        for j in range(net.width):
            np.add.at(grad["filters"][j], (np.take_along_axis(chunks, place + j, axis=1), each), dtop)
        for k, v in theta.items():
            g = grad[k] + net.decay * v
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            v -= (net.rate * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return Model(net, theta["filters"], theta["bias"], theta["out"].astype(float), float(theta["out_bias"][0]))


def held_out(key: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text divides by 5. A null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, net: Net = Net()) -> DataFrame:
    """The bounded training sample: (doc_id, text, y), ``per_class`` rows of each label at most."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id", F.lit(net.seed)), "doc_id"]
    few = [usable.where(F.col("y") == y).dropDuplicates().orderBy(*order).limit(net.per_class) for y in (0, 1)]
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").cast("binary").alias("text")).join(F.broadcast(few[0].union(few[1])), "doc_id")
    return chosen.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("least")).select("doc_id", "least.text", "y")


def train(docs: DataFrame, labels: DataFrame, net: Net = Net()) -> Model:
    """The model of the training sample, which one task holds and fits in a fixed order."""

    def learned(batches: Iterator[pa.RecordBatch]):
        samples = [(text, y) for b in batches for text, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(samples, net))], pa.binary())], names=["model"])

    found = sample(docs, labels, net).repartition(1).sortWithinPartitions("doc_id", "y", "text").mapInArrow(frugal(learned), "model binary").collect()
    return pickle.loads(bytes(found[0]["model"])) if found else fit([], net)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a score for each row's whole text, as a further column."""
    if score.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {score} already; give another name")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = b.column(place).cast(pa.binary()).to_pylist()
            found = scores([t or b"" for t in texts], shared.value)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=[*b.schema.names, score])

    return docs.mapInArrow(frugal(work), T.StructType([*docs.schema, T.StructField(score, T.DoubleType())]))


def predictions(docs: DataFrame, labels: DataFrame, net: Net = Net(), threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score and predicted."""
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = scored(wanted, train(docs, labels, net))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, net: Net = Net(), threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, net))

    def work(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = b.column(0).field("text").cast(pa.binary()).to_pylist()
            yield b.filter(pa.array(scores([t or b"" for t in texts], shared.value) >= threshold))

    rows = docs.select(F.struct("*").alias("row"))
    return rows.mapInArrow(frugal(work), rows.schema).select("row.*")
