"""Repair of conversations' turn structure: the cheapest edits that make roles an optional system turn and pairs of user and assistant.

Faults are found by Spark: a row is blank (nothing but white space), else a duplicate (its role and text stood earlier in its
conversation), else truncated (it doesn't end in ``.``, ``!`` or ``?``). Edits are keep K (0), rerole to user or assistant R (3), delete
D (4, the only one for blank rows and duplicates) and insert an empty user or assistant turn I (3); a truncated row that stays adds 3.
Of the cheapest audits, strings of edits in order, the least by code point counts.

The audit DP goes over the rows with four states: nothing yet, after system, after user, after assistant. A state's best audit so
far is a node of a tree that shares prefixes; a node knows its parent, its ancestors at powers of two and its prefix's rolling hash. Two
audits of equal cost are told apart at the end of their longest common prefix, found by those ancestors in log(length) steps; where
hashes of different nodes agree, the edits themselves are compared. States that can't be on a cheapest audit any more are left, and
what all states share is given out, so that a task holds the part of one conversation that is still open, some rows as a rule.

Rows of a conversation meet in one task, sorted by turn on disk; a digest of its whole text leaves no other way. Null turns come
first, rows of one turn are in order of role and text; repeated rows are duplicates. Rows without conv_id are one conversation. Null
roles and texts are one space, so such texts are blank. Texts of any length stay whole. A conversation without rows has zeros, an
empty audit and the digest of nothing; an empty table gives an empty result. Only the four columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
RETAG, DELETE, INSERT, MEND = 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a state's next user or assistant turn leads, and that turn's role.
NEXT = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: What a kept row's initial leads to, from each state.
KEPT = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = {"su", "ua", "au"}


class Audits:
    """A tree of edits; a node is the audit on the way from the root to it."""

    MODULUS, BASE = (1 << 61) - 1, 1_000_003

    def __init__(self):
        self.edit, self.depth, self.hash, self.up = [""], [0], [0], [[]]

    def add(self, parent: int, edit: str) -> int:
        """A new node; ``up[k]`` is the ancestor 2**k edits above."""
        up, k = [parent], 0
        while k < len(self.up[up[k]]):
            up.append(self.up[up[k]][k])
            k += 1
        self.edit.append(edit)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append(self.next_hash(self.hash[parent], edit))
        self.up.append(up)
        return len(self.up) - 1

    def next_hash(self, above: int, edit: str) -> int:
        return (above * self.BASE + ord(edit)) % self.MODULUS

    def lifted(self, node: int, depth: int) -> int:
        """The ancestor that has ``depth`` edits."""
        while (over := self.depth[node] - depth) > 0:
            node = self.up[node][over.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one length are equal: one node, or equal hashes and then equal edits up to where the paths meet."""
        if a != b and self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.edit[a] != self.edit[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether audit ``a`` comes before ``b``."""
        shorter = min(self.depth[a], self.depth[b])
        x, y = self.lifted(a, shorter), self.lifted(b, shorter)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        # Ever shorter jumps to ancestors that still differ end one edit behind the longest common prefix.
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]) and not self.same(self.up[x][k], self.up[y][k]):
                x, y = self.up[x][k], self.up[y][k]
        return self.edit[x] < self.edit[y]

    def path(self, node: int, top: int = 0) -> list[str]:
        out = []
        while node != top:
            out.append(self.edit[node])
            node = self.up[node][0]
        return out[::-1]

    def meeting(self, nodes: list[int]) -> int:
        """The last node that all have on their way."""
        at = nodes[0]
        for n in nodes[1:]:
            depth = min(self.depth[at], self.depth[n])
            at, n = self.lifted(at, depth), self.lifted(n, depth)
            while at != n:
                at, n = self.up[at][0], self.up[n][0]
        return at


class Repair:
    """One conversation's rows in, in order, its edits out: ``out(edit, role, text)`` for each, in order, once all cheapest audits agree on it."""

    #: Nodes at which what all states share is given out first.
    NODES = 16_384

    def __init__(self, out: Callable[[str, str, str], None]):
        self.out, self.rows, self.place = out, deque(), NOTHING
        self.tree, self.full = Audits(), self.NODES
        self.best: dict[int, tuple[int, int]] = {NOTHING: (0, 0)}
        self.insert(self.best)

    def offer(self, best: dict, state: int, cost: int, above: int, edit: str) -> None:
        """Make the audit ``above`` and ``edit`` the state's best if it is cheaper, or as cheap and less."""
        held = best.get(state)
        if held is None or cost <= held[0]:
            node = self.tree.add(above, edit)
            if held is None or cost < held[0] or self.tree.less(node, held[1]):
                best[state] = (cost, node)

    def insert(self, best: dict) -> None:
        """Turns inserted behind the last row; more than two in a row never pay."""
        for state in (NOTHING, SYSTEM, ASSISTANT):
            if state in best:
                self.offer(best, USER, best[state][0] + INSERT, best[state][1], "I")
        if USER in best:
            self.offer(best, ASSISTANT, best[USER][0] + INSERT, best[USER][1], "I")

    def add(self, role: str, text: str, fault: int) -> None:
        self.rows.append((role, text))
        best: dict[int, tuple[int, int]] = {}
        for state, (cost, node) in self.best.items():
            self.offer(best, state, cost + DELETE, node, "D")
            if fault not in (BLANK, DUPLICATE):
                kept = cost + (MEND if fault == TRUNCATED else 0)
                if (led := KEPT.get((state, role[:1]))) is not None:
                    self.offer(best, led, kept, node, "K")
                self.offer(best, NEXT[state], kept + RETAG, node, "R")
        self.insert(best)
        # From an assistant turn all goes on as from any other state, but for a system row at 4 more; from a user turn after one insert.
        bound = min(best[ASSISTANT][0] + DELETE, best[USER][0] + INSERT + DELETE)
        self.best = {state: held for state, held in best.items() if held[0] <= bound}
        if len(self.tree.up) > self.full:
            self.give_out()

    def give_out(self) -> None:
        """What all states share goes out, and the tree is built again of what lies behind."""
        old, self.tree, nodes = self.tree, Audits(), {}
        top = old.meeting([node for _, node in self.best.values()])
        self.edits(old.path(top))
        nodes[top] = 0
        for state, (cost, node) in self.best.items():
            way = []
            while node not in nodes:
                way.append(node)
                node = old.up[node][0]
            for n in reversed(way):
                nodes[n] = self.tree.add(nodes[node], old.edit[n])
                node = n
            self.best[state] = (cost, nodes[node])
        self.full = max(self.NODES, 2 * len(self.tree.up))

    def edits(self, path: list[str]) -> None:
        for edit in path:
            role, text = ("", "") if edit == "I" else self.rows.popleft()
            if edit == "K":
                self.place = KEPT[self.place, role[:1]]
            elif edit != "D":
                self.place = NEXT[self.place]
                role = ROLE[self.place]
            self.out(edit, role, text)

    def end(self) -> int:
        """Give out the rest and return the cost."""
        ends = [self.best[s] for s in (NOTHING, ASSISTANT) if s in self.best]
        cost, node = ends[0]
        for c, n in ends[1:]:
            if c < cost or c == cost and self.tree.less(n, node):
                cost, node = c, n
        self.edits(self.tree.path(node))
        return cost


def damage(rows: DataFrame) -> DataFrame:
    """Seeded faults: rows (conv_id, turn, role, text, gone), by crc32 of ``conv_id:turn`` mod 20. Dropped rows stay as gone, so their conversation is known."""
    named = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    marked = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), named("role").alias("role"), named("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]+", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text, gone)`` by conversation, in order, with the first fault of each (0: none)."""
    here = rows.repartition("conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "gone", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    said = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(said == "", BLANK).when(F.col("seen"), DUPLICATE).when(~F.right(said, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(0)
    found = here.withColumn("seen", seen).select("conv_id", "turn", "gone", "role", "text", fault.cast("int").alias("fault"), "seen")
    # Of equal rows the first is no duplicate.
    return found.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen").drop("seen")


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, its rows as an iterator, to be read before the next)."""
    flat = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    row = next(flat, None)
    while row is not None:
        conv_id = row[0]

        def rows():
            nonlocal row
            while row is not None and row[0] == conv_id:
                if not row[2]:
                    yield row
                row = next(flat, None)

        mine = rows()
        yield conv_id, mine
        for _ in mine:
            pass


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 1_000, most_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for r in rows:
        held.append(r)
        chars += sum(len(x) for x in r if isinstance(x, str))
        if len(held) >= most or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], f.type) for i, f in enumerate(schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], f.type) for i, f in enumerate(schema)], schema=schema)


def repair(rows: DataFrame) -> DataFrame:
    """The edits (conv_id, place, edit, role, text), in order of place; without those of edit D they are the repaired conversations.

    ``rows`` has conv_id, turn, role, text and gone.
    """
    schema = pa.schema({"conv_id": pa.int64(), "place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            for conv_id, mine in conversations(batches):
                ready: deque[tuple] = deque()
                r, place = Repair(lambda *edit: ready.append(edit)), 0
                for _, _, _, role, text, fault in mine:
                    r.add(role, text, fault)
                    while ready:
                        yield conv_id, place, *ready.popleft()
                        place += 1
                r.end()
                while ready:
                    yield conv_id, place, *ready.popleft()
                    place += 1

        yield from batched(edits(), schema)

    return with_faults(rows).mapInArrow(work, "conv_id long, place long, edit string, role string, text string")


class Digest:
    """What is said of a conversation: counts of its rows, its audit and a digest of what the edits give out."""

    def __init__(self):
        self.faults, self.illegal, self.turns, self.first, self.last, self.initial = [0, 0, 0, 0], 0, 0, None, None, None
        self.audit, self.lines, self.hash = [], 0, hashlib.sha256()

    def row(self, turn: int | None, role: str, fault: int) -> None:
        self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if turn is not None and turn != self.last:
            self.turns += 1
            self.first, self.last = turn if self.first is None else self.first, turn

    def edit(self, edit: str, role: str, text: str) -> None:
        self.audit.append(edit)
        if edit != "D":
            self.hash.update(f"{'' if not self.lines else chr(10)}{role}:{text}".encode())
            self.lines += 1

    @property
    def gaps(self) -> int:
        return self.last - self.first + 1 - self.turns if self.turns else 0


def report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows(conv_id, turn, role, text, gone)``: gaps, faults, cost, audit and the repaired text's digest."""
    schema = pa.schema({"conv_id": pa.int64()} | {k: pa.int64() for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": pa.string(), "repaired_sha256": pa.string()})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[tuple]:
            for conv_id, mine in conversations(batches):
                d = Digest()
                r = Repair(d.edit)
                for _, turn, _, role, text, fault in mine:
                    d.row(turn, role, fault)
                    r.add(role, text, fault)
                cost = r.end()
                yield conv_id, d.gaps, *d.faults[1:], d.illegal, cost, "".join(d.audit), d.hash.hexdigest()

        yield from batched(digests(), schema)

    return with_faults(rows).mapInArrow(work, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
