from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from lorekiln.llm import turn_repair as tr
from lorekiln.llm.queries import QUERIES, damaged

SPACE = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?")


def classed(rows):
    """Faults of (turn, role, text) rows in order."""
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACE)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append(fault)
    return out


def cheapest(initials, faults):
    """(cost, audit, roles) of the best repair: Dijkstra over (turns read, roles so far's state)
    with whole strings, so by another way than layers and ranks."""
    start = {"u": (0, 1, 3), "a": (2,), "s": (0,)}
    heap, best = [(0, "", 0, 0, "")], {}
    while heap:
        cost, audit, read, state, roles = heapq.heappop(heap)
        if (read, state) in best:
            continue
        best[read, state] = (cost, audit, roles)
        for role, into in (("u", 2), ("a", 3)):
            if state in start[role]:
                heapq.heappush(heap, (cost + 3, audit + "I", read, into, roles + role))
        if read < len(initials):
            heapq.heappush(heap, (cost + 4, audit + "D", read + 1, state, roles))
            if faults[read] not in ("blank", "duplicate"):
                extra = 3 if faults[read] == "truncated" else 0
                own = initials[read]
                if own in start and state in start[own]:
                    heapq.heappush(heap, (cost + extra, audit + "K", read + 1, {"s": 1, "u": 2, "a": 3}[own], roles + own))
                for role, into in (("u", 2), ("a", 3)):
                    if state in start[role]:
                        heapq.heappush(heap, (cost + 3 + extra, audit + "R", read + 1, into, roles + role))
    return min(best[len(initials), q] for q in (0, 3) if (len(initials), q) in best)


def brute_force(rows):
    """The report's values and the repaired lines of one conversation's rows after damage."""
    faults, initials = classed(rows), [r[1][:1] for r in rows]
    cost, audit, roles = cheapest(initials, faults)
    lines, at, made = [], 0, 0
    for letter in audit:
        if letter in "KR":
            role = rows[at][1] if letter == "K" else {"u": "user", "a": "assistant"}[roles[made]]
            lines.append(f"{role}:{rows[at][2]}")
        elif letter == "I":
            lines.append({"u": "user:", "a": "assistant:"}[roles[made]])
        made += letter != "D"
        at += letter != "I"
    numbers = [r[0] for r in rows if r[0] is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit), lines


def in_order(rows):
    first = lambda n: (n is not None, n or 0)
    return sorted(rows, key=lambda r: (first(r[0]), r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def drawn(seed, most=9):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "open", "", " \n", "Three?  ", "four\t", "Five. six"]
    roles = ["user", "assistant", "system", "tool", "u", "Assistant", ""]
    return [(rng.choice([None, *range(12)]), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1])[0], rng.choice(texts) * rng.choice([1, 1, 1, 2])) for _ in range(rng.randint(0, most))]


@pytest.mark.parametrize("seed", range(60))
def test_layers_are_the_cheapest_way(seed):
    rows = in_order(drawn(seed, 12))
    if not rows:
        return
    faults, initials = classed(rows), [r[1][:1] for r in rows]
    cost, audit, roles = cheapest(initials, faults)
    assert GOOD.fullmatch(roles)
    for sizes in ([len(rows)], [1] * len(rows), [2] * (len(rows) // 2) + [1] * (len(rows) % 2)):
        pieces, at = [], 0
        for size in sizes:
            piece = tr.Piece(tuple(tr.STATES))
            for k in range(at, at + size):
                piece.add(initials[k], faults[k])
            pieces.append(piece.paths())
            at += size
        found = tr.chained(pieces)
        own = [next(p for p in paths if (p["entry"], p["exit"]) == s) for paths, s in zip(pieces, found.states, strict=True)]
        assert (found.cost, "".join(p["audit"] for p in own) + found.ending) == (cost, audit)


def test_every_short_sequence():
    for n in range(1, 5):
        for symbols in product([("s", ""), ("u", ""), ("a", ""), ("a", "blank"), ("u", "truncated"), ("t", "")], repeat=n):
            piece = tr.Piece((0,))
            for initial, fault in symbols:
                piece.add(initial, fault)
            found = tr.chained([piece.paths()])
            audit = next(p["audit"] for p in piece.paths() if (0, p["exit"]) == found.states[0]) + found.ending
            assert (found.cost, audit) == cheapest(*zip(*symbols, strict=True))[:2]


def test_letters_are_frozen_rightly():
    rng = random.Random(5)
    symbols = [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated"])) for _ in range(500)]
    piece = tr.Piece((0,))
    for initial, fault in symbols:
        piece.add(initial, fault)
    found = tr.chained([piece.paths()])
    audit = next(p["audit"] for p in piece.paths() if (0, p["exit"]) == found.states[0]) + found.ending
    assert (found.cost, audit) == cheapest(*zip(*symbols, strict=True))[:2]


def repaired(spark, rows):
    out = tr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string, at int, k int"))
    report = {r[0]: tuple(r[1:]) for r in out.report.collect()}
    lines: dict = {}
    for r in sorted(out.turns.collect(), key=lambda r: (r.at, r.k)):
        lines.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    return report, lines


def test_tables_are_brute_force_whatever_the_partitions(spark):
    convs = {k or None: in_order(drawn(k)) for k in range(60)}
    convs[1000] = in_order([(k, ("user", "assistant")[k % 2] if k % 7 else "system", f"Turn {k}." if k % 5 else "Same.") for k in range(700)])
    convs[1001] = in_order([(3, "user", "Again.")] * 400)
    rows = [(c, *r, "x", 1, 2) for c, own in convs.items() for r in own]
    random.Random(1).shuffle(rows)
    wanted = {c: brute_force(own) for c, own in convs.items() if own}
    for partitions in ("1", "13"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            report, lines = repaired(spark, rows)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert report == {c: w[0] for c, w in wanted.items()}
        assert lines == {c: w[1] for c, w in wanted.items() if w[1]}


def test_empty_table(spark):
    report, lines = repaired(spark, [])
    assert (report, lines) == ({}, {})


def test_query_is_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(c if c % 9 else None, t if t % 5 else t * 2, rng.choice(["user", "assistant", "system", None]), rng.choice(["Yes.", "no", None, "", "Is it? Yes! "]) or None)
            for c in range(80) for t in range(rng.randint(1, 8))]
    rows += [(500 + c, 0, "user", "Only one.") for c in range(40)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    after: dict = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        after[c] += [(t, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    wanted = {}
    for c, own in after.items():
        values, lines = brute_force(in_order(own))
        wanted[c] = (*values, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    got = QUERIES["op11_turn_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == wanted
    assert any(not own for own in after.values())


def test_damage_keeps_its_columns(spark):
    rows = spark.createDataFrame([(1, 2, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    assert damaged(rows).columns == ["conv_id", "turn", "role", "text"]
    assert damaged(rows.filter(F.lit(False))).count() == 0
