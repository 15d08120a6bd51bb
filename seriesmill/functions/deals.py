"""Deals of columns' values to other rows: many deals of a table of numbered rows as one shuffle of packed values."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a row's place in its block, and the values that are packed at a time.
PLACE_BITS, LOT_VALUES = 15, 2_000_000


def deal(n: int, seed: int) -> tuple[int, int]:
    """A deal of n values: row number i gets the value of number a * i + b, modulo n; a has no factor of n."""
    rng = random.Random(seed)
    a = next(x for x in iter(lambda: rng.randrange(1, max(n, 2)), None) if math.gcd(x, n) == 1)
    return a, rng.randrange(max(n, 1))


def times(a: int, numbers: np.ndarray, n: int) -> np.ndarray:
    """a * numbers modulo n, of unsigned numbers below n; over 2^31 by 16 bits at a time, so that 64 bits hold all products up to an n of 2^46."""
    a, n = np.uint64(a), np.uint64(n)
    if n <= 1 << 31:
        return a * numbers % n
    out = np.zeros_like(numbers)
    for shift in (32, 16, 0):
        out = ((out << np.uint64(16)) + a * (numbers >> np.uint64(shift) & np.uint64(0xFFFF))) % n
    return out


def dealt_all(ordered: DataFrame, n: int, columns: Sequence[str], deals: Sequence[tuple[str, int]]) -> DataFrame:
    """Numbers in ``columns`` of rows numbered by _n, below ``n``, as doubles that are not null, and _dealt0, _dealt1, ...: for each (column, seed) the value that its deal gives the row.

    Rows lie in blocks of 2^PLACE_BITS numbers. A task packs the values that it has for a block, its rows' own and those dealt to it, into one
    record, so the shuffle has few records, and a block's task puts them in their places.
    """
    names, width, bits = [*columns, *(f"_dealt{k}" for k in range(len(deals)))], len(columns) + len(deals), PLACE_BITS
    blocks, lot = -(-n // (1 << bits)), max(1, LOT_VALUES // width)
    from_column = [*range(len(columns)), *(list(columns).index(c) for c, _ in deals)]
    back = [(pow(a, -1, n) if n > 1 else 0, n - b) for a, b in (deal(n, seed) for _, seed in deals)]
    kind = np.uint16 if blocks <= 1 << 16 else np.uint32
    modulo = times

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        own, values = table.column("_n").to_numpy().astype(np.uint64), [table.column(c).to_numpy() for c in columns]
        to = np.concatenate([own] * len(columns) + [modulo(a, (own + np.uint64(b)) % np.uint64(n), n) for a, b in back])
        block = (to >> np.uint64(bits)).astype(kind)
        order = np.argsort(block, kind="stable")
        slots = np.repeat(np.arange(width, dtype=np.int64), len(own))
        counts = np.bincount(block.astype(np.int64) * width + slots, minlength=blocks * width).astype(np.int32).reshape(-1, width)
        ends = np.r_[0, np.cumsum(counts.sum(axis=1))]
        some = np.flatnonzero(np.diff(ends))
        ends = np.r_[0, ends[some + 1]]

        def binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
            return pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((ends * data.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])

        places = (to & np.uint64((1 << bits) - 1)).astype(np.uint16)[order]
        packed = [binary(counts[some].ravel(), np.arange(len(some) + 1) * width), binary(places, ends), binary(np.concatenate([values[c] for c in from_column])[order], ends)]
        return pa.record_batch([pa.array(some, pa.int64()), *packed], names=["block", "counts", "places", "values"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, lot):
                part = batch.slice(start, lot)
                if rows and rows + part.num_rows > lot:
                    yield pack(kept)
                    kept, rows = [], 0
                kept.append(part)
                rows += part.num_rows
        if rows:
            yield pack(kept)

    def place(key: tuple[pa.Scalar, ...], records: pa.Table) -> pa.Table:
        rows = min(1 << bits, n - (key[0].as_py() << bits))
        out = np.full(width * rows, np.nan)
        for counts, places, values in zip(*(records.column(c) for c in ("counts", "places", "values"))):
            starts = np.repeat(np.arange(width) * rows, np.frombuffer(counts.as_buffer(), np.int32))
            out[starts + np.frombuffer(places.as_buffer(), np.uint16)] = np.frombuffer(values.as_buffer(), np.float64)
        return pa.table(list(out.reshape(width, rows)), names=names)

    numbers = ordered.select("_n", *[F.col(c).cast("double").alias(c) for c in columns])
    packed = numbers.mapInArrow(send, "block long, counts binary, places binary, values binary")
    return packed.groupBy("block").applyInArrow(place, ", ".join(f"`{c}` double" for c in names))
