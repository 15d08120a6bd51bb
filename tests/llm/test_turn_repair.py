"""Repair of conversations against all audits there are, against a plain DP over strings, and in SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest
from seriesmill.llm import turn_repair
from seriesmill.llm.queries import QUERIES
from seriesmill.llm.turn_repair import Audits, Repair, damage, repair, report

from ..oracle import SF, both

FAULTS = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}


def every_audit(rows: list[tuple[str, int]], most: int):
    """(cost, audit, roles) of all audits up to ``most``, legal or not."""

    def go(i, cost, audit, roles):
        if cost > most:
            return
        if i == len(rows):
            yield cost, audit, roles
        for r in "ua":
            yield from go(i, cost + 3, audit + "I", roles + r)
        if i < len(rows):
            role, fault = rows[i]
            yield from go(i + 1, cost + 4, audit + "D", roles)
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                yield from go(i + 1, cost + extra, audit + "K", roles + (role[:1] or "?"))
                for r in "ua":
                    yield from go(i + 1, cost + extra + 3, audit + "R", roles + r)

    yield from go(0, 0, "", "")


def cheapest(rows: list[tuple[str, int]]) -> tuple[int, str]:
    return min((c, a) for c, a, roles in every_audit(rows, 4 * len(rows)) if re.fullmatch("(s?(ua)+)?", roles))


def by_strings(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """The same by a DP that keeps whole strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "")}

    def inserted(b):
        for _ in range(2):
            for state, (c, a) in list(b.items()):
                to = step.get((state, "u")) or step[state, "a"]
                b[to] = min(b.get(to, (10**12, "")), (c + 3, a + "I"))
        return b

    best = inserted(best)
    for role, fault in rows:
        now = {}
        for state, (c, a) in best.items():
            offers = [(state, c + 4, a + "D")]
            if fault not in (1, 2):
                extra = 3 if fault == 3 else 0
                offers += [(step[state, role[:1]], c + extra, a + "K")] if (state, role[:1]) in step else []
                offers += [(step.get((state, "u")) or step[state, "a"], c + extra + 3, a + "R")]
            for to, cost, audit in offers:
                now[to] = min(now.get(to, (10**12, "")), (cost, audit))
        best = inserted(now)
    return min(best[s] for s in ("", "a") if s in best)


def mended(rows: list[tuple[str, int]], nodes: int | None = None) -> tuple[int, str]:
    audit = []
    r = Repair(lambda edit, role, text: audit.append(edit))
    if nodes:
        r.NODES = r.full = nodes
    for role, fault in rows:
        r.add(role, "", fault)
    return r.end(), "".join(audit)


def test_cheapest_of_all_audits():
    for n in range(4):
        for rows in product(product(("user", "assistant", "system", "tool"), (0, 2, 3)), repeat=n):
            if n < 3 or hash(rows) % 7 == 0:
                assert mended(list(rows)) == by_strings(list(rows)) == cheapest(list(rows)), rows
    chance = random.Random(1)
    for _ in range(12):
        rows = [(chance.choice(["user", "assistant", "system", ""]), chance.choice([0, 0, 1, 3])) for _ in range(4)]
        assert mended(rows) == cheapest(rows), rows


@pytest.mark.parametrize("nodes", [None, 20])
def test_long_conversations_and_shared_prefixes_given_out(nodes):
    chance = random.Random(2)
    for roles in (["user", "assistant"], ["user"], ["assistant"], ["system"], ["user", "assistant", "system", "x"]):
        for faults in ([0], [0, 0, 3], [0, 1, 2, 3], [1]):
            rows = [(chance.choice(roles), chance.choice(faults)) for _ in range(chance.randrange(300))]
            assert mended(rows, nodes) == by_strings(rows)


def test_what_is_held_does_not_grow():
    chance, r, most = random.Random(3), Repair(lambda *edit: None), 0
    for _ in range(100_000):
        r.add(chance.choice(["user", "assistant"]), "", chance.choice([0, 0, 0, 2, 3]))
        most = max(most, len(r.tree.up))
    assert most <= Repair.NODES + 20 and len(r.rows) <= Repair.NODES


def test_hash_collisions_are_seen():
    class Colliding(Audits):
        def next_hash(self, above, edit):
            return 0

    for kind in (Audits, Colliding):
        t, chance, nodes = kind(), random.Random(4), {"": 0}
        for _ in range(300):
            text, node = chance.choice(list(nodes.items()))
            e = chance.choice("DIKR")
            if text + e not in nodes:
                nodes[text + e] = t.add(node, e)
        some = chance.sample(list(nodes), 100)
        assert all(t.less(nodes[a], nodes[b]) == (a < b) for a in some for b in some)
        # Equal audits on different nodes are equal.
        assert t.same(t.add(nodes["K"] if "K" in nodes else t.add(0, "K"), "D"), t.add(t.add(0, "K"), "D"))


def plain(rows: list[tuple]) -> dict:
    """The whole query in one loop."""
    shown = lambda x: " " if x is None else str(x)
    out, by_id = {}, {}
    for conv_id, turn, role, text in rows:
        mine = by_id.setdefault(conv_id, [])
        kind, role, text = zlib.crc32(f"{shown(conv_id)}:{shown(turn)}".encode()) % 20, shown(role), shown(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv_id, mine in by_id.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks = set(), []
        for _, role, text in mine:
            said = text.rstrip(" \t\n\v\f\r")
            marks.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
            seen.add((role, text))
        cost, audit = by_strings([(role, FAULTS[m]) for (_, role, _), m in zip(mine, marks)])
        lines, rest, last = [], iter(mine), "a"
        for e in audit:
            role, text = next(rest)[1:] if e != "I" else ("", "")
            if e == "D":
                continue
            role = role if e == "K" else "assistant" if last == "u" else "user"
            last = role[:1]
            lines.append(f"{role}:{text}")
        turns = {t for t, _, _ in mine if t is not None}
        out[conv_id] = {
            "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(), **{m: marks.count(m) for m in ("blank", "duplicate", "truncated")},
        }
    return out


def held_against_plain(found: list, rows: list[tuple]) -> None:
    mine = {r["conv_id"]: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in found}
    assert len(mine) == len(found) and mine == plain(rows)


@lru_cache
def odd_rows() -> tuple:
    chance, rows = random.Random(5), []
    for conv_id in [None, *range(-3, 60)]:
        for _ in range(chance.randrange(12)):
            text = chance.choice([None, "", " \n", "ok", "ok.", "no!\n", "é?", "a.b!c?", "line\nline", "x" * 3_000 + "."])
            rows.append((conv_id, chance.choice([None, 0, 1, 2, 3, 7, 10**12]), chance.choice([None, "", "user", "assistant", "system", "tool", "ass"]), text))
    return tuple(rows + rows[:40] + [(77, t, "user", "same.") for t in range(200)] + [(78, 4, "assistant", "same.")] * 200)


def test_odd_rows(spark):
    df = spark.createDataFrame(list(odd_rows()), "conv_id long, turn long, role string, text string").selectExpr("*", "1 as gone", "'x' as fault", "2 as kind").repartition(5)
    held_against_plain(report(damage(df)).collect(), list(odd_rows()))
    assert report(damage(df.limit(0))).collect() == []


def test_odd_rows_in_sql(spark):
    import duckdb
    from seriesmill.llm import sql

    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", odd_rows())
    result = con.execute(sql.TURN_REPAIR)
    names = [c[0] for c in result.description]
    theirs = {r[0]: dict(zip(names[1:], r[1:])) for r in result.fetchall()}
    assert theirs == plain(list(odd_rows()))


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    held_against_plain(QUERIES["op13_turn_repair"](spark, SF).collect(), rows)
    mine, theirs = both(spark, QUERIES["op13_turn_repair"], turn_repair_sql())
    assert mine == theirs


def turn_repair_sql() -> str:
    from seriesmill.llm import sql

    return sql.TURN_REPAIR


def test_repaired_rows(spark):
    damaged = damage(spark.read.parquet(f"{SF}/conversations.parquet"))
    edits = repair(damaged).orderBy("conv_id", "place").collect()
    said = {r["conv_id"]: r for r in report(damaged).collect()}
    by_id: dict = {}
    for e in edits:
        by_id.setdefault(e["conv_id"], []).append(e)
    assert {c: "".join(e["edit"] for e in es) for c, es in by_id.items()} == {c: r["audit"] for c, r in said.items() if r["audit"]}
    for c, es in by_id.items():
        kept = [e for e in es if e["edit"] != "D"]
        assert [e["place"] for e in es] == list(range(len(es))) and re.fullmatch("(s?(ua)+)?", "".join(e["role"][0] for e in kept))
        assert hashlib.sha256("\n".join(f"{e['role']}:{e['text']}" for e in kept).encode()).hexdigest() == said[c]["repaired_sha256"]
    assert turn_repair.TRUNCATED == FAULTS["truncated"]
