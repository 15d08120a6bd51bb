"""SentencePiece encoding and decoding by a distinct-chunk table.

No piece of the vocabularies this serves joins a character to a white-space marker on its right, so merges never
leave a chunk: a run of markers with the characters up to the next one. A chunk is therefore segmented the same
wherever it stands. The chunks of a slice of documents are reduced by Arrow to the distinct ones, those are looked up in a table
that the Python worker keeps, new ones are segmented once with the library itself, and the documents' ids are taken from the
distinct chunks' ids by position.

The table is bounded and belongs to a worker. It has two halves: when the newer one is full it becomes the older one, whose chunks move
back when they are met again; others are forgotten when the next half is full. A table of all chunks of the corpus would grow with the
corpus, and joining it back would shuffle a row for every word.

Null texts are encoded as empty ones (the end id alone); null lists of ids are decoded as empty ones, null ids in a list
are skipped. Texts of any length are encoded whole; slices are cut by their characters, so a task holds few long
texts at once. Rows are independent, so ties and repeated rows need no rule. Every other column is passed through
untouched; one that has the name of the column to be made is an error. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import frugal, text_of

MARK = "▁"
#: Entries of each half of a worker's table, and the characters of the longest chunk that is kept. Longer ones are segmented each time.
TABLE_ENTRIES, TABLE_CHARS = 300_000, 64
#: Documents, and bytes of their texts, that are worked on together; a longer document is alone.
SLICE, SLICE_BYTES = 2_048, 1 << 22


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices that are bounded by rows and by the bytes of column ``text``."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, at = np.cumsum(size), 0
    while at < batch.num_rows:
        fits = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, side="right"))
        behind = max(at + 1, min(fits, at + SLICE))
        yield batch.slice(at, behind - at)
        at = behind


def new_column(columns: list[str], name: str) -> str:
    """``name``, if no column has it yet."""
    if name.lower() in (c.lower() for c in columns):
        raise ValueError(f"there is a column {name} already; give another name")
    return name


@lru_cache(maxsize=2)
def processor(model: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model)


def crosses_marks(pieces) -> bool:
    """Whether some piece has a marker after another character; the chunk table would then be wrong."""
    return any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)


class Remembered:
    """What ``find`` gives for chunks, each found once while it is remembered."""

    def __init__(self, find: Callable[[list[str]], list], most: int = TABLE_ENTRIES):
        self.find, self.most = find, most
        #: The newer half, and the older one.
        self.table: dict = {}
        self.older: dict = {}

    def of(self, chunks: list[str]) -> list:
        """The findings for distinct ``chunks``, in their order."""
        found = list(map(self.table.get, chunks))
        places = [i for i, x in enumerate(found) if x is None]
        if places:
            missed = [chunks[i] for i in places]
            old = list(map(self.older.get, missed))
            new = iter(self.find([c for c, x in zip(missed, old) if x is None]))
            for i, c, x in zip(places, missed, old):
                found[i] = x = next(new) if x is None else x
                if len(c) <= TABLE_CHARS:
                    self.table[c] = x
            if len(self.table) > self.most:
                self.table, self.older = {}, self.table
        return found


def plain(text: str) -> bool:
    """Whether single spaces, and these alone, part the chunks of ``text``."""
    return text != "" and text[0] != " " and text[-1] != " " and "  " not in text and MARK not in text


def cut(text: str) -> list[str]:
    """The chunks of a text, its dummy prefix included; a chunk is named without its first marker."""
    return [c[1:] for c in re.findall(" +[^ ]*", " " + text.replace(MARK, " "))] if text else []


def runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its size says, one run after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def distinct_chunks(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct chunks of ``texts``, which of them stands at each place, and the number of places of each text."""
    easy = np.fromiter(map(plain, texts), bool, len(texts))
    split = pc.split_pattern(pa.array([t for t, e in zip(texts, easy) if e], pa.large_string()), " ")
    parts = [cut(t) for t, e in zip(texts, easy) if not e]
    coded = pa.chunked_array([split.flatten(), pa.array(chain.from_iterable(parts), pa.large_string())]).combine_chunks().dictionary_encode()
    which, places = coded.indices.to_numpy(zero_copy_only=False), np.zeros(len(texts), np.int64)
    places[easy] = split.value_lengths().to_numpy(zero_copy_only=False)
    places[~easy] = np.fromiter(map(len, parts), np.int64, len(parts))
    if not easy.all():
        # Plain texts were counted first: back into the order of ``texts``.
        order = np.argsort(~easy, kind="stable")
        starts = np.empty_like(places)
        starts[order] = np.cumsum(places[order]) - places[order]
        which = which[runs(starts, places)]
    return coded.dictionary.to_pylist(), which, places


class ChunkTable:
    """Encodes texts with ids by chunk."""

    def __init__(self, model: str):
        self.library = processor(model)
        if crosses_marks(self.library.id_to_piece(i) for i in range(self.library.get_piece_size())):
            raise ValueError("a piece crosses a white-space marker; chunks are not independent")
        self.mark = array("i", [self.library.piece_to_id(MARK)]).tobytes()
        self.table = Remembered(self.segment)

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Ids as bytes of int32; the library takes an empty text for one without a marker."""
        found = self.library.encode(chunks, num_threads=1)
        flat, ends = array("i", chain.from_iterable(found)).tobytes(), accumulate(4 * len(ids) for ids in found)
        return [flat[lo:hi] if c else self.mark for c, (lo, hi) in zip(chunks, pairwise(chain([0], ends)), strict=True)]

    def encode(self, texts: list[str], end: list[int] = []) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
        """The ids of ``texts`` one after the other, ``end`` behind each, and how many each has."""
        chunks, which, places = distinct_chunks(texts)
        joined = pa.array(self.table.of(chunks), pa.large_binary()).take(pa.array(which))
        _, offsets, data = joined.buffers()
        edges = np.frombuffer(offsets, np.int64)[np.concatenate([[0], np.cumsum(places)])] if len(joined) else np.zeros(len(texts) + 1, np.int64)
        view, last = memoryview(data or b""), array("i", end).tobytes()
        coded = b"".join(chain.from_iterable((view[lo:hi], last) for lo, hi in pairwise(edges.tolist())))
        return np.frombuffer(coded, dtype=np.int32), np.diff(edges) // 4 + len(end)


@lru_cache(maxsize=2)
def chunk_table(model: str) -> ChunkTable:
    """The table of this Python worker: later tasks of the worker find the chunks of earlier ones."""
    return ChunkTable(model)


def lists(column: pa.ListArray) -> list[list[int]]:
    """A column's lists, from its flat values; nulls are empty and left out."""
    if column.values.null_count:
        return [[i for i in v or () if i is not None] for v in column.to_pylist()]
    flat = column.flatten().to_numpy(zero_copy_only=False).tolist()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)).tolist()
    return [flat[lo:hi] for lo, hi in zip([0, *ends], ends)]


def encode_batches(batches: Iterator[pa.RecordBatch], model: str, text: str, ids: str, add_end: bool = True) -> Iterator[pa.RecordBatch]:
    """The batches with column ``ids`` in place of ``text``."""
    table, end = chunk_table(model), [processor(model).eos_id()] * add_end
    for whole in batches:
        place = whole.schema.get_field_index(text)
        for batch in slices(whole, place):
            found, lengths = table.encode([t or "" for t in batch.column(place).to_pylist()], end)
            column = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(found))
            columns, names = list(batch.columns), list(batch.schema.names)
            columns[place], names[place] = column, ids
            yield pa.RecordBatch.from_arrays(columns, names=names)


def decode_lists(model: str, ids: list[list[int]]) -> list[str]:
    """The library's ``decode`` of each list."""
    library = processor(model)
    return [library.decode(v) if v else "" for v in ids]


def decode_batches(batches: Iterator[pa.RecordBatch], model: str, ids: str, text: str) -> Iterator[pa.RecordBatch]:
    """The batches with column ``text``, the decoded ``ids``, at the end."""
    for batch in batches:
        texts = decode_lists(model, lists(batch.column(batch.schema.get_field_index(ids))))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, text])


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", add_end: bool = True) -> DataFrame:
    """``docs`` with the token ids of ``text`` in its place, as ``ids`` array<int>."""
    new_column([c for c in docs.columns if c != text], ids)
    schema = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType())) if f.name == text else f for f in docs.schema])
    return docs.mapInArrow(lambda batches: encode_batches(batches, model, text, ids, add_end), schema)


def decode(tokens: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``tokens`` with the decoded text as a further column."""
    schema = T.StructType([*tokens.schema, T.StructField(new_column(tokens.columns, text), T.StringType())])
    return tokens.mapInArrow(lambda batches: decode_batches(batches, model, ids, text), schema)


def round_trip_digests(docs: DataFrame, model: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256; both steps and the digests run in one pass of Python."""
    names = [str(i) for i in range(processor(model).get_piece_size())]

    def digests(batches):
        for b in encode_batches(batches, model, "text", "ids"):
            ids = lists(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(" ".join(map(names.__getitem__, x)).encode()).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decode_lists(model, ids)], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return wanted.mapInArrow(frugal(digests), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
