"""Fact groups: claims of a tag and fact type, first fit in order.

A claim joins the first group that has a member with the same claim or quote, or whose first claim
is similar enough; else it begins a group. That is sequential by definition, but for two facts: like
claims with like quotes share their fate, and a claim meets only the first claims of groups. So
claims are numbered by a prefix scan and decided in blocks of a bounded number; of the blocks before
only their first claims and the groups of their quotes come in: a task holds the first claims of one block
and looks them over for each claim of another. Large buckets take more rounds, not larger tasks, and no
pairs of claims are shuffled.

Similar: no different numbers, and a matching ratio of 0.88 or a share of common words of 0.82. A ratio
of 0.88 leaves at most 12 % of the characters of both unmatched, so that two claims of n and m characters
have 0.2 (n + m) - 2 runs of three characters in common.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.functions.batches import small_batches
from lorekiln.operators.quotes import small
from lorekiln.operators.ranges import Ranges, Running
from lorekiln.sources.shared import Workspace

#: Fixed thresholds: similar claims by ratio or by shared words; groups of a tag.
CLAIM_RATIO, CLAIM_JACCARD, MOST_GROUPS = 0.88, 0.82, 200
#: Rows of a bucket that one task decides at a time.
BLOCK = 2000
#: Words and numbers of claims, as :func:`lorekiln.functions.text.claim_words` and ``numbers`` have them.
WORDS, NUMBERS = re.compile(T.CLAIM_WORD), re.compile(T.NUMBER)


class Firsts:
    """First claims of groups in order. A later claim is compared only with those that may be similar: by words with
    the firsts of its rarest words, by ratio with those within bounds of length, of common characters (all firsts
    at once) and of common runs of three. The bounds are proved, so that nothing similar is left out."""

    BINS = 64

    def __init__(self) -> None:
        self.claims: list[dict] = []
        self.signs: list[frozenset | None] = []
        self.words: dict[str, list[int]] = {}
        self.kinds: dict[frozenset, int] = {frozenset(): 0}
        self.lengths, self.numbers = np.zeros(16, np.int64), np.zeros(16, np.int64)
        self.chars = np.zeros((16, self.BINS), np.int32)

    def _seen(self, claim: dict) -> None:
        """What bounds need of a claim, worked out once."""
        if "chars" not in claim:
            codes = np.frombuffer(claim["claim"].encode("utf-32-le", "surrogatepass"), np.uint32)
            claim["chars"] = np.bincount(codes % self.BINS, minlength=self.BINS).astype(np.int32)
            claim["kind"] = self.kinds.setdefault(frozenset(claim["numbers"]), len(self.kinds))

    @staticmethod
    def _runs(text: str) -> frozenset:
        """All runs of three characters, told apart by how often they came before."""
        times: dict[str, int] = {}
        out = []
        for k in range(len(text) - 2):
            run = text[k : k + 3]
            n = times[run] = times.get(run, 0) + 1
            out.append(run if n == 1 else (run, n))
        return frozenset(out)

    def add(self, claim: dict) -> None:
        self._seen(claim)
        at = len(self.claims)
        if at == len(self.lengths):
            self.lengths, self.numbers, self.chars = (np.concatenate([c, np.zeros_like(c)]) for c in (self.lengths, self.numbers, self.chars))
        self.lengths[at], self.numbers[at], self.chars[at] = len(claim["claim"]), claim["kind"], claim["chars"]
        for word in claim["words"]:
            self.words.setdefault(word, []).append(at)
        self.signs.append(claim.get("runs"))  # most are never asked for
        claim.pop("masks", None)
        self.claims.append(claim)

    def _by_words(self, claim: dict) -> set[int]:
        """Firsts that share enough words. Of so many words all but a few are shared, one of the rarest is."""
        size, found = len(claim["words"]), set()
        if size:
            few = size - math.ceil(CLAIM_JACCARD * size - 1e-9) + 1
            for places in sorted((self.words.get(w, []) for w in claim["words"]), key=len)[:few]:
                found.update(places)
        return {k for k in found if self._share(claim, self.claims[k])}

    @staticmethod
    def _share(a: dict, b: dict) -> bool:
        few, many = sorted((len(a["words"]), len(b["words"])))
        if few < CLAIM_JACCARD * many:
            return False
        shared = len(a["words"] & b["words"])
        return shared / (few + many - shared) >= CLAIM_JACCARD

    def _close(self, claim: dict, k: int) -> bool:
        text, other = claim["claim"], self.claims[k]["claim"]
        size = len(text) + len(other)
        if "runs" not in claim:
            claim["runs"] = self._runs(text)
        if self.signs[k] is None:
            self.signs[k] = self._runs(other)
        if len(claim["runs"] & self.signs[k]) < 0.2 * size - 2.0001:
            return False
        if size <= S.LCS_LONGEST:
            if "masks" not in claim:
                claim["masks"] = S.places(text)
            least = (CLAIM_RATIO - 1e-9) * size / 2
            if S.common_in_order(claim["masks"], len(text), other, least) < least:
                return False
        return SequenceMatcher(None, text, other).ratio() >= CLAIM_RATIO

    def near(self, claim: dict) -> int | None:
        """The node of the earliest first that ``claim`` is similar to."""
        n = len(self.claims)
        if not n:
            return None
        self._seen(claim)
        able = (self.numbers[:n] == claim["kind"]) | (self.numbers[:n] == 0) | (claim["kind"] == 0)
        best = min((k for k in self._by_words(claim) if able[k]), default=n)
        text = claim["claim"]
        if text and best:
            lengths = self.lengths[:best]
            total = lengths + len(text)
            open_ = np.flatnonzero(able[:best] & (lengths > 0) & (2 * np.minimum(lengths, len(text)) >= CLAIM_RATIO * total))
            common = np.minimum(self.chars[open_], claim["chars"]).sum(axis=1)
            for k in open_[2 * common >= (CLAIM_RATIO - 1e-9) * total[open_]].tolist():
                if self._close(claim, k):
                    best = k
                    break
        return self.claims[best]["node"] if best < n else None


def first_fit(units: Iterator[tuple[dict, str, int | None, int | None]]) -> Iterator[int]:
    """The group, by its first claim's number, of each (claim, quote, base, known) in order. Claims carry
    node, claim, words and numbers; ``base`` is the least similar group of earlier claims that are not
    among these, ``known`` that of the quote."""
    firsts = Firsts()
    quotes: dict[str, int] = {}
    now, group = None, None
    for claim, quote, base, known in units:
        if now is None or claim["node"] != now:
            now, group = claim["node"], base
            if group is None:
                group = firsts.near(claim)
        found = [g for g in (group, known, quotes.get(quote) if quote else None) if g is not None]
        if not found:
            firsts.add(claim)
        group = min(found, default=claim["node"])  # later rows of the claim have a member in it
        if quote:
            quotes[quote] = min(group, quotes.get(quote, group))
        yield group


def _fold(table: pa.Table) -> pa.Table:
    """Decides a block of one bucket."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["node"], r["quote"]))
    units = (({"node": r["node"], "claim": r["claim"], "words": set(r["words"]), "numbers": set(r["numbers"])}, r["quote"], r["base"], r["known"]) for r in rows)
    columns = [[r["node"] for r in rows], [r["quote"] for r in rows], list(first_fit(units))]
    return pa.Table.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())], ["node", "quote", "group"])


def _whole(rows: list[dict]) -> Iterator[tuple[int, int, int]]:
    """Decides a bucket of few rows: (row, its group's first row, rank); ``rank`` counts the bucket's groups."""
    if len(rows) == 1:
        yield 0, 0, 0
        return
    order = sorted(range(len(rows)), key=lambda k: tuple(rows[k][c] for c in ("claim", "quote", "doc", "name")))
    units, heads, last = [], [], None  # claims are numbered as they come
    for k in order:
        claim = rows[k]["claim"]
        if last is None or (claim, rows[k]["apart"]) != last:
            last = (claim, rows[k]["apart"])
            words, numbers = set(WORDS.findall(claim)), {n.replace(",", ".") for n in NUMBERS.findall(claim)}
            now = {"node": len(heads), "claim": claim, "words": words, "numbers": numbers}
            heads.append(k)
        units.append((now, rows[k]["quote"], None, None))
    groups = list(first_fit(iter(units)))
    ranks = {g: n for n, g in enumerate(sorted(set(groups)))}
    for k, group in zip(order, groups, strict=True):
        yield k, heads[group], ranks[group]


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tag, kind, id, group, rank) of many buckets of few rows, which follow one another."""
    held: list[dict] = []
    for batch in batches:
        names, out = batch.schema, {"tag": [], "kind": [], "id": [], "group": [], "rank": []}
        for row in batch.to_pylist():
            if held and (row["tag"], row["kind"]) != (held[0]["tag"], held[0]["kind"]):
                _decide(held, out)
                held = []
            held.append(row)
        yield _placed(out, names)
    if held:
        _decide(held, out := {"tag": [], "kind": [], "id": [], "group": [], "rank": []})
        yield _placed(out, names)


def _decide(rows: list[dict], out: dict[str, list]) -> None:
    for k, first, rank in _whole(rows):
        values = rows[k]["tag"], rows[k]["kind"], rows[k]["id"], rows[first]["id"], rank
        for column, value in zip(out.values(), values, strict=True):
            column.append(value)


def _placed(out: dict[str, list], names: pa.Schema) -> pa.RecordBatch:
    kinds = {"tag": pa.string(), "kind": pa.string(), "id": names.field("id").type, "group": names.field("id").type, "rank": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(out[c], kind) for c, kind in kinds.items()], list(kinds))


def fact_groups(claims: DataFrame, tag: str, kind: str, id_col: str, claim: str, quote: str, doc: str, most: int = MOST_GROUPS, block: int = BLOCK) -> DataFrame:
    """(id, tag, kind, group, overflow) for every row of ``claims``: ``group`` is the id of its group's
    first row. Of a tag's groups beyond ``most``, in order of kind and first claim, ``overflow`` is true:
    such a group keeps its first row and goes to review. Null tags, kinds, claims and quotes count
    as empty; ids are unique. Buckets of ``block`` rows and fewer are decided at once."""
    small_batches(claims.sparkSession)
    work = Workspace(claims.sparkSession, "fact-groups")
    text = lambda c: T.text_or_empty(F.col(c).cast("string"))
    rows = claims.select(text(tag).alias("tag"), text(kind).alias("kind"), F.col(id_col).alias("id"), text(doc).alias("doc"), T.claim_key(F.col(claim)).alias("claim"), T.claim_key(F.col(quote)).alias("quote"))
    # What has neither claim nor quote is like nothing else; what has no claim is told by its quote.
    apart = F.when(F.col("claim") != "", "").when(F.col("quote") != "", F.col("quote")).otherwise(F.concat(F.lit("\x00"), F.col("id").cast("string")))
    rows = work.keep(rows.withColumn("apart", apart), "rows")
    large = work.keep(rows.groupBy("tag", "kind").agg(F.count("*").alias("n")).filter(F.col("n") > block).select("tag", "kind"), "large")
    few = rows.join(small(large), ["tag", "kind"], "left_anti").withColumn("name", F.col("id").cast("string"))
    kind_of_id = rows.schema["id"].dataType.simpleString()
    few = few.repartition("tag", "kind").sortWithinPartitions("tag", "kind")  # most buckets are a row or two: no group of its own for each
    placed = few.mapInArrow(_buckets, f"tag string, kind string, id {kind_of_id}, group {kind_of_id}, rank bigint")
    if not large.isEmpty():
        placed = placed.unionByName(_in_blocks(rows.join(small(large), ["tag", "kind"], "left_semi"), block, work))
    placed = work.keep(placed, "placed")
    earlier = Window.partitionBy("tag").orderBy("kind").rowsBetween(Window.unboundedPreceding, -1)  # a row per kind
    counts = placed.groupBy("tag", "kind").agg((F.max("rank") + 1).alias("groups")).withColumn("before", F.coalesce(F.sum("groups").over(earlier), F.lit(0)))
    found = placed.join(counts.select("tag", "kind", "before"), ["tag", "kind"])
    return found.select(F.col("id").alias(id_col), "tag", "kind", "group", (F.col("before") + F.col("rank") >= most).alias("overflow"))


def _in_blocks(rows: DataFrame, block: int, work: Workspace) -> DataFrame:
    """(tag, kind, id, group, rank) of buckets that are too large for one task."""
    same = ["tag", "kind", "claim", "apart"]
    first = F.min(F.struct("quote", "doc", F.col("id").cast("string").alias("name"), "id"))
    nodes = rows.groupBy(*same).agg(first.alias("first"))
    numbered = Ranges(nodes, ["tag", "kind"], ["claim", "first"]).add(place=Running("count", before=True))
    nodes = numbered.rows.select(F.col("__at").alias("node"), *same, F.col("first.id").alias("first_id"), (F.col("place") / block).cast("int").alias("block"))
    nodes = work.keep(nodes.withColumn("words", T.claim_words(F.col("claim"))).withColumn("numbers", T.numbers(F.col("claim"))), "nodes")
    units = work.keep(rows.join(nodes.select(*same, "node", "block"), same).groupBy("tag", "kind", "node", "block", "quote").agg(F.count("*").alias("copies")), "units")
    groups = _decided(nodes, units, work)
    heads = nodes.select(F.col("node").alias("group"), "tag", "kind", "first_id").join(groups.select("group").distinct(), "group")
    ranked = Ranges(heads, ["tag", "kind"], ["group"]).add(rank=Running("count", before=True)).result()
    placed = rows.join(nodes.select(*same, "node"), same).join(groups, ["node", "quote"])
    return placed.join(ranked.select("group", "first_id", "rank"), "group").select("tag", "kind", "id", F.col("first_id").alias("group"), "rank")


def _decided(nodes: DataFrame, units: DataFrame, work: Workspace) -> DataFrame:
    """(node, quote, group), round by round."""
    last = nodes.agg(F.max("block")).first()[0] or 0
    base = None  # (node, base): least group of earlier blocks that is similar
    done = None
    for turn in range(last + 1):
        asked = units.filter(F.col("block") == turn).join(nodes.filter(F.col("block") == turn).select("node", "claim", "words", "numbers"), "node")
        if turn:
            known = done.filter("quote <> ''").join(units.select("node", "tag", "kind", "quote"), ["node", "quote"]).groupBy("tag", "kind", "quote").agg(F.min("group").alias("known"))
            asked = asked.join(base, "node", "left").join(known, ["tag", "kind", "quote"], "left")
        else:
            asked = asked.withColumn("base", F.lit(None).cast("bigint")).withColumn("known", F.lit(None).cast("bigint"))
        asked = asked.select("tag", "kind", "node", "claim", "words", "numbers", "quote", "base", "known")
        found = asked.groupBy("tag", "kind").applyInArrow(_fold, "node bigint, quote string, group bigint")
        found = work.keep(found, f"groups-{turn}")
        done = found if done is None else done.unionByName(found)
        if turn < last:
            base = work.keep(_nearest(nodes, found, base, turn), f"base-{turn}")
    return done


def _nearest(nodes: DataFrame, found: DataFrame, base: DataFrame | None, turn: int) -> DataFrame:
    """(node, base) of the claims of later blocks: the least of ``base`` and of the similar groups that
    this turn began. Groups of earlier turns are smaller, so claims that have one are not compared."""
    begun = found.filter("node = group").select("node").distinct()
    later = nodes.filter(F.col("block") > turn)
    if base is not None:
        later = later.join(base.select("node"), "node", "left_anti")
    columns = ["tag", "kind", "block", "node", "claim", "words", "numbers"]
    heads = nodes.drop("block").join(begun, "node").join(later.select("tag", "kind", "block").distinct(), ["tag", "kind"])
    heads = heads.select(*[F.col(c).alias(f"head_{c}") for c in columns])
    both = heads.groupBy("head_tag", "head_kind", "head_block").cogroup(later.select(*columns).groupBy("tag", "kind", "block"))
    fresh = both.applyInArrow(_near, "node bigint, base bigint")
    return fresh if base is None else base.unionByName(fresh)


def _near(heads: pa.Table, later: pa.Table) -> pa.Table:
    """The earliest of ``heads``, first claims of a block, that each claim of a later block is similar to."""
    claim = lambda r: {"node": r["node"], "claim": r["claim"], "words": set(r["words"]), "numbers": set(r["numbers"])}
    firsts = Firsts()
    for row in sorted(heads.rename_columns(later.column_names).to_pylist(), key=lambda r: r["node"]):
        firsts.add(claim(row))
    found = [(r["node"], near) for r in later.to_pylist() if (near := firsts.near(claim(r))) is not None]
    return pa.Table.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["node", "base"])
