"""Repair of damaged conversations by dynamic programming over their grammar.

A sound conversation is empty, or a system turn at most and then pairs of user and assistant.
A turn is kept, gets another role, is deleted, or turns without text are inserted before or after
it. A forward Viterbi pass over the four states of the grammar (nothing yet, after system, after
user, after assistant) carries for each the least (cost, audit string) of what leads there; each
turn's layer is closed by at most two inserts.

Long conversations are split. Turns are sorted by ranges, so a conversation may lie in several
tasks; each works out its piece for every state it may begin in. What the pieces cost and how
their audit strings compare are a few numbers, which are chained per conversation: so many
rows as tasks, not as turns. The chosen edits are then exploded and joined to the turns by their
place, a key without repeats. No task holds a conversation, and texts are only moved, not gathered.

Audit strings grow with a conversation. A state holds the letters of the last turns only; those
before are frozen, and stand for themselves by their rank among the four states. As all of them
end in a turn's own edit, none is the beginning of another one, so ranks stay right.

Defined results
    null roles and texts count as empty; null conversations are one conversation.
    turns are taken in order of their number, nulls first; ties by role and then by the text's
    hash, so that equal rows are neighbours: the second one is a duplicate.
    faults, the first that holds: blank (no character but white space), duplicate (role and text
    seen earlier), truncated (last such character is not one of ``.!?``).
    gaps are missing numbers between the first and the last one; null if too many for a bigint.
    an empty table gives empty results; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant.
STATES = range(4)
#: State after a user or assistant turn, or None where the grammar has no such turn.
NEXT_USER, NEXT_ASSISTANT = (2, 2, None, 2), (None, None, 3, None)
#: States in which a conversation may end, after these inserts.
ENDINGS = {0: "", 1: "II", 2: "I", 3: ""}
#: Turns after which letters are frozen.
FROZEN_AFTER = 64
LEGAL = ("su", "ua", "au")

#: A state's best way so far: cost, rank of its frozen letters, letters and states since, and the
#: frozen ones as a linked list.
Way = tuple[int, int, str, str, tuple | None]


def _moves(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """(state, state after, cost, letter) of all edits of a turn."""
    moves = [(q, q, DELETE, "D") for q in STATES]
    if fault in ("blank", "duplicate"):
        return moves
    extra = TRUNCATED if fault == "truncated" else 0
    for q in STATES:
        kept = {"s": 1 if q == 0 else None, "u": NEXT_USER[q], "a": NEXT_ASSISTANT[q]}.get(initial)
        if kept is not None:
            moves.append((q, kept, KEEP + extra, "K"))
        other = NEXT_USER[q] or NEXT_ASSISTANT[q]
        moves.append((q, other, REROLE + extra, "R"))
    return moves


MOVES = {(i, f): _moves(i, f) for i in ("s", "u", "a", "") for f in ("", "blank", "duplicate", "truncated")}


def _better(new: Way, old: Way | None) -> bool:
    return old is None or new[:3] < old[:3]


def _closed(ways: list[Way | None]) -> list[Way | None]:
    """Ways with inserts after them, up to two."""
    now = list(ways)
    for _ in range(2):
        for q, way in enumerate(list(now)):
            if way is not None:
                after = NEXT_USER[q] or NEXT_ASSISTANT[q]
                new = (way[0] + INSERT, way[1], way[2] + "I", way[3], way[4])
                if _better(new, now[after]):
                    now[after] = new
    return now


def _frozen(ways: list[Way | None]) -> list[Way | None]:
    ranks = {key: k for k, key in enumerate(sorted({way[1:3] for way in ways if way is not None}))}
    return [way and (way[0], ranks[way[1:3]], "", "", (way[4], way[2], way[3])) for way in ways]


def _whole(way: Way) -> tuple[str, str]:
    """All letters and states of a way."""
    audit, trail, rest = [way[2]], [way[3]], way[4]
    while rest is not None:
        rest, letters, states = rest
        audit.append(letters)
        trail.append(states)
    return "".join(reversed(audit)), "".join(reversed(trail))


class Piece:
    """Consecutive turns of a conversation, for some states in which it may begin."""

    def __init__(self, entries: tuple[int, ...]):
        self.size = 0
        self.ways: dict[int, list[Way | None]] = {e: [(0, 0, "", "", None) if q == e else None for q in STATES] for e in entries}

    def add(self, initial: str, fault: str) -> None:
        moves = MOVES[initial if initial in ("s", "u", "a") else "", fault]
        for entry, ways in self.ways.items():
            if self.size and self.size % FROZEN_AFTER == 0:
                ways = _frozen(ways)
            before, after = _closed(ways), [None] * 4
            for q, into, cost, letter in moves:
                way = before[q]
                if way is not None:
                    new = (way[0] + cost, way[1], way[2] + letter, way[3] + str(into), way[4])
                    if _better(new, after[into]):
                        after[into] = new
            self.ways[entry] = after
        self.size += 1

    def paths(self) -> list[dict]:
        """The best way for each state at the beginning and at the end, ranked by letters."""
        found = [(entry, q, way[0], *_whole(way)) for entry, ways in self.ways.items() for q, way in enumerate(ways) if way is not None]
        ranks = {audit: k for k, audit in enumerate(sorted({f[3] for f in found}))}
        return [{"entry": e, "exit": q, "cost": c, "rank": ranks[a], "audit": a, "trail": t} for e, q, c, a, t in found]


@dataclass(frozen=True)
class Chosen:
    """Entry and exit state of each piece, inserts at the end, and the cost of it all."""

    states: list[tuple[int, int]]
    ending: str
    cost: int


def chained(pieces: list[list[dict]]) -> Chosen:
    """The cheapest chain of paths through the pieces of a conversation, ties by letters."""
    now: dict[int, tuple[int, int, list | None]] = {0: (0, 0, None)}
    for paths in pieces:
        best: dict[int, tuple] = {}
        for path in paths:
            start = now.get(path["entry"])
            if start is not None:
                new = (start[0] + path["cost"], start[1], path["rank"], path["entry"], start[2])
                if path["exit"] not in best or new[:3] < best[path["exit"]][:3]:
                    best[path["exit"]] = new
        ranks = {key: k for k, key in enumerate(sorted({b[1:3] for b in best.values()}))}
        now = {q: (b[0], ranks[b[1:3]], (b[4], b[3], q)) for q, b in best.items()}
    cost, _, ending, last = min(
        ((c + INSERT * len(ENDINGS[q]), r, ENDINGS[q], q) for q, (c, r, _) in now.items()),
    )
    states, rest = [], now[last][2]
    while rest is not None:
        rest, entry, end = rest
        states.append((entry, end))
    return Chosen(states[::-1], ending, cost)


_PATH = pa.struct([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("rank", pa.int32()), ("audit", pa.string()), ("trail", pa.string())])
_NUMBERS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE_DDL = (
    "at bigint, size bigint, split boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint,"
    " first_initial string, last_initial string, ending string, cost bigint, paths array<struct<entry int, exit int, cost bigint, rank int, audit string, trail string>>"
)


def _pieces(conv_type: pa.DataType):
    """Turns in order to pieces of conversations."""
    schema = pa.schema(
        [("conv", conv_type), ("at", pa.int64()), ("size", pa.int64()), ("split", pa.bool_()), *[(n, pa.int64()) for n in _NUMBERS]]
        + [("first_turn", pa.int64()), ("last_turn", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string())]
        + [("ending", pa.string()), ("cost", pa.int64()), ("paths", pa.list_(_PATH))]
    )

    def done(row: dict, piece: Piece, split: bool) -> dict:
        row |= {"size": piece.size, "split": split, "paths": piece.paths()}
        if not split:
            found = chained([row["paths"]])
            row |= {"ending": found.ending, "cost": found.cost, "paths": [p for p in row["paths"] if (p["entry"], p["exit"]) == found.states[0]]}
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, piece, head, before, out = None, None, True, None, []
        for batch in batches:
            for conv, at, turn, initial, fault in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                new = row is None or conv != row["conv"]
                torn = row is None or at != before + 1
                if new or torn:
                    if row is not None:  # a piece that may have other ones before or after it is split
                        out.append(done(row, piece, head or not new))
                        head = not new
                    row = dict.fromkeys(schema.names, None) | dict.fromkeys(_NUMBERS, 0) | {"conv": conv, "at": at, "first_initial": initial}
                    piece = Piece((0,) if new and before is not None else tuple(STATES))
                else:
                    row["illegal"] += row["last_initial"] + initial not in LEGAL
                if fault:
                    row[fault] += 1
                if turn is not None and turn != row["last_turn"]:
                    row["turns"] += 1
                    row["first_turn"] = turn if row["first_turn"] is None else row["first_turn"]
                    row["last_turn"] = turn
                row["last_initial"], before = initial, at
                piece.add(initial, fault)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if row is not None:
            out.append(done(row, piece, True))
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


_LINK = pa.schema([("at", pa.int64()), ("entry", pa.int32()), ("exit", pa.int32()), ("chain_ending", pa.string()), ("chain_cost", pa.int64()), ("seam", pa.int64()), ("shared", pa.int64())])


def _chain(table: pa.Table) -> pa.Table:
    """Of the pieces of a split conversation: the path of each; the last has cost and ending.
    ``seam`` and ``shared`` are illegal neighbours and common turns of a piece and that before it."""
    rows = sorted(table.to_pylist(), key=lambda r: r["at"])
    found = chained([r["paths"] for r in rows])
    out, last = [], None
    for k, (row, (entry, end)) in enumerate(zip(rows, found.states, strict=True)):
        link = {"at": row["at"], "entry": entry, "exit": end, "chain_ending": "", "chain_cost": 0, "seam": 0, "shared": 0}
        if k:
            link["seam"] = int(rows[k - 1]["last_initial"] + row["first_initial"] not in LEGAL)
            link["shared"] = int(last is not None and last == row["first_turn"])
        last = row["last_turn"] if row["last_turn"] is not None else last
        out.append(link)
    out[-1] |= {"chain_ending": found.ending, "chain_cost": found.cost}
    return pa.Table.from_pylist(out, _LINK)


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, at, turn, initial, fault) of each turn."""
    same = ["conv", "role", "digest"]
    again = rows.groupBy(*same).agg(F.min("at").alias("first_at"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = again.select("first_at", *[F.col(c).alias(f"__{c}") for c in same])
    meets = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in same]
    found = rows.join(again, meets, "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("at") != F.col("first_at"), "duplicate").when(F.col("truncated"), "truncated").otherwise("")
    return found.select("conv", "at", "turn", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault"))


@dataclass(frozen=True)
class Repaired:
    """report: a row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit.
    turns: the repaired turns: conv, at, k (their order), turn (null where inserted), role, text, edit."""

    report: DataFrame
    turns: DataFrame


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repaired:
    """Conversations put in order at the least cost."""
    work = Workspace(turns.sparkSession, "turn-repair")
    text = F.coalesce(F.col(text_col), F.lit(""))
    body = F.rtrim(text, F.lit(SPACE))
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), text.alias("text"),
        F.sha2(text, 256).alias("digest"), (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    order = ["conv", "turn", "role", "digest", "spread"]  # equal rows may be many: they are spread as well
    ordered = rows.withColumn("spread", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("spread")
    rows = work.keep(ordered.withColumn("at", F.monotonically_increasing_id()), "rows")
    faults = work.keep(_faults(rows), "faults")
    conv_type = faults.limit(0).toArrow().schema.field("conv").type
    conv_ddl = faults.schema["conv"].dataType.simpleString()
    streams = faults.repartitionByRange("at").sortWithinPartitions("at").select("conv", "at", "turn", "initial", "fault")
    pieces = work.keep(streams.mapInArrow(_pieces(conv_type), f"conv {conv_ddl}, {_PIECE_DDL}"), "pieces")
    return Repaired(*_results(rows, pieces, work))


def _results(rows: DataFrame, pieces: DataFrame, work: Workspace) -> tuple[DataFrame, DataFrame]:
    bare = F.transform("paths", lambda p: F.struct(p["entry"].alias("entry"), p["exit"].alias("exit"), p["cost"].alias("cost"), p["rank"].alias("rank")))
    links = pieces.filter("split").select("conv", "at", "first_initial", "last_initial", "first_turn", "last_turn", bare.alias("paths"))
    links = work.keep(links.groupBy("conv").applyInArrow(_chain, "at bigint, entry int, exit int, chain_ending string, chain_cost bigint, seam bigint, shared bigint"), "links")
    linked = pieces.filter("split").join(links, "at")
    path = F.get(F.filter("paths", lambda p: (p["entry"] == F.col("entry")) & (p["exit"] == F.col("exit"))), F.lit(0))
    shown = ["conv", "at", "size", "blank", "duplicate", "truncated"]
    split = linked.select(*shown, (F.col("illegal") + F.col("seam")).alias("illegal"), (F.col("turns") - F.col("shared")).alias("turns"), "first_turn", "last_turn",
                          path.alias("path"), F.col("chain_ending").alias("ending"), F.col("chain_cost").alias("cost"))
    whole = pieces.filter("not split").select(*shown, "illegal", "turns", "first_turn", "last_turn", F.get("paths", F.lit(0)).alias("path"), "ending", "cost")
    return _report(whole, split), _turns(rows, whole.unionByName(split))


def _report(whole: DataFrame, split: DataFrame) -> DataFrame:
    def shown(rows: DataFrame, audit: Column) -> DataFrame:
        wide = F.col("last_turn").cast("decimal(20,0)") - F.col("first_turn") + 1 - F.col("turns")
        gaps = F.when(F.col("first_turn").isNull(), F.lit(0)).otherwise(wide.try_cast("bigint")).alias("gaps")
        return rows.select("conv", gaps, "blank", "duplicate", "truncated", "illegal", "cost", audit.alias("audit"))

    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "cost")]
    letters = F.array_sort(F.collect_list(F.struct("at", F.concat("path.audit", "ending").alias("audit"))))
    joined = split.groupBy("conv").agg(*sums, F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), letters.alias("letters"))
    return shown(whole, F.concat("path.audit", "ending")).unionByName(shown(joined, F.array_join("letters.audit", "")))


def _turns(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Edits by place, joined to the turns they edit."""
    tokens = F.regexp_extract_all("path.audit", F.lit("I*[KRD]"), F.lit(0))
    begins = F.split(F.concat(F.col("path.entry").cast("string"), F.left("path.trail", F.length("path.trail") - 1)), "")
    zipped = F.arrays_zip(tokens.alias("token"), F.split("path.trail", "").alias("after"), begins.alias("before"))
    edits = chosen.select("at", "size", "ending", F.posexplode(zipped).alias("k", "edit"))
    ends = F.when(F.col("k") == F.col("size") - 1, F.length("ending")).otherwise(0)
    edits = edits.select(
        (F.col("at") + F.col("k")).alias("at"), (F.length("edit.token") - 1).alias("ahead"), F.right("edit.token", F.lit(1)).alias("letter"),
        F.col("edit.before").cast("int").alias("before"), F.col("edit.after").cast("int").alias("after"), ends.alias("behind"),
    )

    def turn(k: Column, role: Column, edit: str, own: bool = False) -> Column:
        number, text = (F.col("turn"), F.col("text")) if own else (F.lit(None).cast("bigint"), F.lit(""))
        return F.struct(k.cast("int").alias("k"), number.alias("turn"), role.alias("role"), text.alias("text"), F.lit(edit).alias("edit"))

    def inserts(count: Column, state: Column, first: int) -> Column:
        users = (state != 2).cast("int")  # whether the first of them is a user
        places = F.filter(F.sequence(F.lit(0), F.lit(1)), lambda j: j < count)
        return F.transform(places, lambda j: turn(j + first, F.when((users + j) % 2 == 1, "user").otherwise("assistant"), "insert"))

    role = F.when(F.col("after") == 2, "user").otherwise("assistant")
    kept, rerole = turn(F.lit(2), F.col("role"), "keep", True), turn(F.lit(2), role, "rerole", True)
    own = F.when(F.col("letter") == "K", F.array(kept)).when(F.col("letter") == "R", F.array(rerole)).otherwise(F.array().cast(_turn_list()))
    every = F.concat(inserts(F.col("ahead"), F.col("before"), 0), own, inserts(F.col("behind"), F.col("after"), 3))
    return rows.select("conv", "at", "turn", "role", "text").join(edits, "at").select("conv", "at", F.explode(every).alias("t")).select("conv", "at", "t.*")


def _turn_list() -> str:
    return "array<struct<k:int,turn:bigint,role:string,text:string,edit:string>>"
