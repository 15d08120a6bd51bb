"""Chat formatting with loss masks that are aligned to tokens by offsets.

A conversation is rendered as ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn and encoded once with offsets. The
three control strings are tokens of their own, so no token reaches over the edge of a text. The loss mask marks the
tokens of assistant texts: spans and token offsets are both sorted, and binary search finds each span's tokens.

Control strings inside roles and texts are escaped reversibly: ``<``, any number of backslashes and ``|`` get one
backslash more, so that ``<|`` never stands in a text.

Rows of a conversation meet in one task, sorted by turn on disk; ties are put in order of role and text. A task holds
a part of a conversation at a time: parts end between turns once they have ``part_chars`` characters, and tokens do
not depend on where parts end. Short conversations are encoded together, GROUP_CHARS characters at a time. Null texts and
roles count as empty, rows with a null conv_id are one conversation, null turns come first, repeated rows are turns of
their own. An empty table gives an empty result. Only conv_id, turn, role and text are read, so other columns may have any
name.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
TURN = re.compile(rf"{re.escape(START)}(.*?){re.escape(SEP)}(.*?){re.escape(END)}", re.S)
TRAINED_ROLE = "assistant"
#: Characters, at least, of conversations that are encoded together.
GROUP_CHARS = 200_000


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


@lru_cache(maxsize=2)
def tokenizer(file: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(file)
    t.add_special_tokens([START, SEP, END])
    return t


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The rendered turns, and the spans of the texts to train on, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, text = f"{START}{escape(role)}{SEP}", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(text)))
        parts += [head, text, END]
        at += len(head) + len(text) + len(END)
    return "".join(parts), spans


def loss_mask(spans: list[tuple[int, int]], offsets: np.ndarray) -> np.ndarray:
    """Whether each token lies in a span; ``offsets`` are the tokens' (start, end), both sorted."""
    mask = np.zeros(len(offsets), dtype=bool)
    if len(offsets) and spans:
        edges = np.array(spans)
        first = np.searchsorted(offsets[:, 1], edges[:, 0], side="right")
        behind = np.searchsorted(offsets[:, 0], edges[:, 1], side="left")
        for lo, hi in zip(first.tolist(), behind.tolist()):
            mask[lo:hi] = True
    return mask


SCHEMA = "conv_id long, part int, last boolean, formatted string, ids array<int>, loss array<boolean>"


@dataclass
class Part:
    conv_id: int | None
    number: int
    turns: list[tuple[str, str]] = field(default_factory=list)
    chars: int = 0


def parts(batches: Iterator[pa.RecordBatch], part_chars: int) -> Iterator[tuple[Part, bool]]:
    """Parts of conversations, each with whether it is the conversation's last."""
    now: Part | None = None
    for b in batches:
        for conv_id, role, text in zip(*(b.column(k).to_pylist() for k in range(3))):
            if now and conv_id != now.conv_id:
                yield now, True
                now = None
            elif now and now.chars >= part_chars:
                yield now, False
                now = Part(conv_id, now.number + 1)
            now = now or Part(conv_id, 0)
            now.turns.append((role, text))
            now.chars += len(role) + len(text)
    if now:
        yield now, True


def encoded_parts(held: list[tuple[Part, bool]], t) -> pa.RecordBatch:
    """A row of SCHEMA for each part."""
    rendered = [render(part.turns) for part, _ in held]
    found = t.encode_batch([text for text, _ in rendered], add_special_tokens=False)
    sizes = [len(e) for e in found]
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    ids = np.fromiter(chain.from_iterable(e.ids for e in found), np.int32, sum(sizes))
    offsets = (np.fromiter(chain.from_iterable(e.offsets), np.int64, 2 * n).reshape(-1, 2) for e, n in zip(found, sizes))
    masks = [loss_mask(spans, of) for (_, spans), of in zip(rendered, offsets)]
    columns = [
        pa.array([part.conv_id for part, _ in held], pa.int64()), pa.array([part.number for part, _ in held], pa.int32()), pa.array([last for _, last in held], pa.bool_()),
        pa.array([text for text, _ in rendered], pa.string()), pa.ListArray.from_arrays(ends, pa.array(ids)), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(masks))),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "last", "formatted", "ids", "loss"])


def formatted(batches: Iterator[pa.RecordBatch], file: str, part_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows of SCHEMA for all parts, in their order."""
    t, held, chars = tokenizer(file), [], 0
    for part, last in parts(batches, part_chars):
        held.append((part, last))
        chars += part.chars
        if chars >= GROUP_CHARS or len(held) >= 1_000:
            yield encoded_parts(held, t)
            held, chars = [], 0
    if held:
        yield encoded_parts(held, t)


def by_conversation(rows: DataFrame) -> DataFrame:
    wanted = rows.select(F.col("conv_id").cast("long").alias("conv_id"), text_of("role").alias("role"), text_of("text").alias("text"), F.col("turn").cast("long").alias("turn"))
    return wanted.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", "role", "text")


def format_conversations(rows: DataFrame, file: str, part_chars: int = 1_000_000) -> DataFrame:
    """Per conversation of ``rows(conv_id, turn, role, text)``: its formatted text, token ids and loss mask, in parts."""
    return by_conversation(rows).mapInArrow(lambda batches: formatted(batches, file, part_chars), SCHEMA)


@dataclass
class Digest:
    """What is read back from a conversation's parts."""

    turns: int = 0
    turns_hash: object = field(default_factory=hashlib.sha256)
    loss_chars: int = 0
    loss_hash: object = field(default_factory=hashlib.sha256)
    chars: int = 0

    def add(self, text: str, said: list[str]) -> None:
        """A part's text, and what is under its loss mask, span by span."""
        self.chars += len(text)
        for m in TURN.finditer(text):
            self.turns += 1
            self.turns_hash.update(f"{unescape(m[1])}\n{unescape(m[2])}\n".encode())
        for x in map(unescape, said):
            self.loss_chars += len(x)
            self.loss_hash.update(x.encode())


def under_mask(batch: pa.RecordBatch, t) -> list[list[str]]:
    """The texts of each row's runs of masked tokens. A row begins and ends outside the mask, so no run goes on in the next."""
    ids, loss = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in (4, 5))
    edges = np.flatnonzero(np.diff(np.concatenate([[0], loss.astype(np.int8), [0]])))
    found = t.decode_batch([ids[lo:hi].tolist() for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist())], skip_special_tokens=False)
    ends = np.cumsum(batch.column(4).value_lengths().to_numpy(zero_copy_only=False))
    upto = np.searchsorted(edges[::2], ends).tolist()
    return [found[lo:hi] for lo, hi in zip([0, *upto], upto)]


def round_trip_digests(rows: DataFrame, file: str, part_chars: int = 1_000_000) -> DataFrame:
    """Per conversation, read back from its formatted parts: digests of all turns and of the text under the loss mask."""

    kinds = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(), "formatted_chars": pa.int64()}

    def work(batches: Iterator[pa.RecordBatch]):
        t, now, done = tokenizer(file), Digest(), []
        for b in formatted(batches, file, part_chars):
            for conv_id, last, text, said in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), under_mask(b, t)):
                now.add(text, said)
                if last:
                    done.append((conv_id, now.turns, now.turns_hash.hexdigest(), now.loss_chars, now.loss_hash.hexdigest(), now.chars))
                    now = Digest()
            if len(done) >= 1_000:
                yield listed(done)
                done = []
        yield listed(done)

    def listed(done: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds.values())], names=list(kinds))

    return by_conversation(rows).mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
