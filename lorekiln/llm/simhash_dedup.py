"""SimHash near-duplicates by covering codes.

A fingerprint has 64 bits, cut into blocks. With three blocks, of two fingerprints that differ in
at most 4 bits some block differs in at most 1; with two blocks, in at most 2. In each block, the
anchors are a covering code: a perfect Hamming code, of covering radius 1, with all values of
the bits beyond it. Each fingerprint has its nearest anchor as home and goes to every anchor
within radius plus what its block may differ in; at an anchor, all that came meet those at home
there, so no link is missed. Three blocks have 2 ** 17 anchors and visits to about 15 of them;
two blocks, for very many fingerprints, 2 ** 27 and about 170.

Equal fingerprints are one row from the start. Homes of a crowded anchor are dealt over
several tasks, and what meets them streams by, so a task holds at most ``HOMES`` of them.

Defined results
    null texts have no words; without words the fingerprint is zero, linked like any other.
    null ids never name a component that has another id.
    repeated rows and copies share fingerprint and component; an empty table gives an empty
    result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import small_batches
from lorekiln.llm.stars import spanning_stars
from lorekiln.operators.graph import connected_components
from lorekiln.sources.shared import Workspace

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: Homes at an anchor that one task holds.
HOMES = 4096
#: Pairs that are compared at a time.
PAIRS = 1 << 17
#: Near pairs that are held before they are passed on.
FOUND = 1 << 19


@dataclass(frozen=True)
class Layout:
    """First bit and number of bits of each block, of which the low ``code_bits`` are the
    Hamming code's; a block differs in at most ``threshold`` bits."""

    blocks: tuple[tuple[int, int], ...]
    code_bits: int
    threshold: int


THREE_BLOCKS = Layout(((0, 21), (21, 21), (42, 22)), 15, 1)
TWO_BLOCKS = Layout(((0, 32), (32, 32)), 31, 2)
#: Distinct fingerprints from which the two blocks compare less than three: an anchor of three
#: has n / 2 ** 17 homes, so pairs grow with the square of n, and visits don't.
MANY = 1 << 26


def layout_of(n: int) -> Layout:
    """Both layouts find the same links."""
    return THREE_BLOCKS if n < MANY else TWO_BLOCKS


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingles(text: str | None, length: int) -> np.ndarray:
    """XXH64 of all runs of ``length`` words, repeats included; shorter texts are one run."""
    words = (text or "").encode().translate(_LOWER).split()  # bytes: ASCII white space only
    if not words:
        return np.zeros(0, "<u8")
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < length:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(starts) - length + 1], ends[length - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], "<u8")


def fingerprint(text: str | None) -> int:
    """Majority bits over the XXH64 of all shingles, repeats included."""
    hashes = shingles(text, SHINGLE)
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit integer."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("bigint")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))

    return docs.withColumn(out, of(F.col(text_col)))


def syndromes(words: np.ndarray, code_bits: int) -> np.ndarray:
    """Of the low bits of each word: 0 at a codeword, else the place of the wrong bit, from 1."""
    found = np.zeros_like(words)
    for bit in range(code_bits):
        found ^= np.where(words >> np.uint64(bit) & np.uint64(1), np.uint64(bit + 1), np.uint64(0))
    return found


def corrected(words: np.ndarray, wrong: np.ndarray) -> np.ndarray:
    """The anchor nearest to each word."""
    return words ^ np.where(wrong > 0, np.uint64(1) << (np.maximum(wrong, np.uint64(1)) - np.uint64(1)), np.uint64(0))


@cache
def _flips(bits: int, code_bits: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All words of at most ``most`` ones, none first, and their syndromes."""
    words = np.array([sum(1 << b for b in some) for k in range(most + 1) for some in combinations(range(bits), k)], np.uint64)
    return words, syndromes(words, code_bits)


def anchors(fps: np.ndarray, layout: Layout, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home of each, rows and anchors within covering radius plus threshold). Such an anchor
    is the home of what differs from the fingerprint in ``threshold`` bits at most. Anchors
    carry the block."""
    first, bits = layout.blocks[block]
    value = fps >> np.uint64(first) & np.uint64((1 << bits) - 1)
    flips, turned = _flips(bits, layout.code_bits, layout.threshold)
    every = corrected(value[:, None] ^ flips, syndromes(value, layout.code_bits)[:, None] ^ turned)
    home = every[:, 0].copy()
    every.sort(axis=1)
    fresh = np.concatenate([np.ones((len(every), 1), bool), every[:, 1:] != every[:, :-1]], axis=1)
    mark = np.uint64(block << 40)
    return home | mark, np.nonzero(fresh)[0], every[fresh] | mark


def _homes(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            homes = np.concatenate([anchors(fps, layout, block)[0] for block in range(len(layout.blocks))])
            yield pa.record_batch([pa.array(homes.view(np.int64))], ["anchor"])

    return run


def _sent(layout: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for block in range(len(layout.blocks)):
                home, rows, near = anchors(fps, layout, block)
                at, sent = np.concatenate([home, near]).view(np.int64), np.concatenate([fps, fps[rows]]).view(np.int64)
                yield pa.record_batch([pa.array(at), pa.array(sent), pa.array(np.arange(len(at)) >= len(home))], ["anchor", "fp", "visits"])

    return run


def meetings(
    batches: Iterator[pa.RecordBatch],
    near: Callable[[np.ndarray, np.ndarray], np.ndarray],
    among_homes: bool,
    crowd: int | None = None,
    forest: Callable[[np.ndarray], np.ndarray] | None = None,
) -> Iterator[np.ndarray]:
    """Rows (group, visits, ...) sorted by group with homes first, the other columns integers.
    Of each batch, yields the pairs that are ``near``: an array of (row, home) columns per pair.
    Visitors meet the homes of their group; with ``among_homes``, homes meet each other. Of a
    group with more than ``crowd`` rows, ``forest`` gives pairs that connect what is near. Many pairs
    of a batch come in several arrays."""
    last, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).to_numpy(zero_copy_only=False)
        visits = batch.column(1).to_numpy(zero_copy_only=False)
        data = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[2:]], axis=1)
        known = 0
        if last is not None and group[0] == last:
            known = len(held)
            group = np.concatenate([np.full(known, last), group])
            data, visits = np.concatenate([held, data]), np.concatenate([np.zeros(known, bool), visits])
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        homes = np.add.reduceat(~visits, begins)
        index = np.searchsorted(begins, np.arange(len(group)), side="right") - 1
        last, held = group[-1], data[begins[-1] : begins[-1] + homes[-1]].copy()
        counts = np.where(visits, homes[index], np.arange(len(group)) - begins[index] if among_homes else 0)
        counts[:known] = 0
        found = []
        if crowd:
            ends = np.append(begins[1:], len(group))
            for k in np.flatnonzero(ends - begins > crowd).tolist():
                counts[begins[k] : ends[k]] = 0
                found.append(forest(data[begins[k] : ends[k]]))
        asking = np.flatnonzero(counts)
        counts = counts[asking]
        ends = np.cumsum(counts)
        at = 0
        while at < len(asking):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, side="right")))
            rows, n = asking[at:to], counts[at:to]
            within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            left, right = data[np.repeat(rows, n)], data[np.repeat(begins[index[rows]], n) + within]
            some = near(left, right)
            if some.any():
                found.append(np.stack([left[some], right[some]], axis=1))
            if sum(map(len, found)) > FOUND:
                yield np.concatenate(found)
                found = []
            at = to
        if found:
            yield np.concatenate(found)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of visitors and homes. Those of a batch are reduced to a star per component;
    none is lost that way."""

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (np.bitwise_count((a ^ b)[:, 0].view(np.uint64)) <= DISTANCE) & (a != b)[:, 0]

    for pairs in meetings(batches, near, among_homes=False):
        x, y = spanning_stars(pairs[:, 0, 0], pairs[:, 1, 0])
        yield pa.record_batch([pa.array(x), pa.array(y)], ["src", "dst"])


def link_fingerprints(distinct: DataFrame, work: Workspace) -> DataFrame:
    """(src, dst): links between distinct fingerprints of the column ``fp``, enough to
    connect all that are within the distance."""
    fps = distinct.select("fp")
    layout = layout_of(distinct.count())
    crowded = fps.mapInArrow(_homes(layout), "anchor bigint").groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOMES)
    crowded = work.keep(crowded.select("anchor", F.ceil(F.col("n") / (HOMES // 2)).cast("int").alias("tasks")), "crowded")
    sent = fps.mapInArrow(_sent(layout), "anchor bigint, fp bigint, visits boolean")
    if crowded.isEmpty():
        sent = sent.withColumn("deal", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("tasks")).cast("int")
        deals = F.when(F.col("tasks").isNull(), F.array(F.lit(0))).when(F.col("visits"), F.sequence(F.lit(0), F.col("tasks") - 1))
        sent = sent.join(crowded, "anchor", "left").withColumn("deal", F.explode(deals.otherwise(F.array(own))))
    group = F.xxhash64("anchor", "deal")  # groups of equal hash are one: more meets, nothing is lost
    dealt = sent.withColumn("group", group).repartition("group").sortWithinPartitions("group", "visits")
    return dealt.select("group", "visits", "fp").mapInArrow(_links, "src bigint, dst bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: its id, fp, component_id and row, a number of its own, and
    whether it is the one of its component that stays."""
    work = Workspace(docs.sparkSession, "simhash")
    rows = fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    rows = work.keep(rows.select("id", "fp", F.monotonically_increasing_id().alias("row")), "rows")
    first = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row"))
    distinct = work.keep(rows.groupBy("fp").agg(first.alias("first")), "distinct")
    links = work.keep(link_fingerprints(distinct, work), "links")
    return name_components(rows, distinct, links, work, id_col)


def name_components(rows: DataFrame, distinct: DataFrame, links: DataFrame, work: Workspace, id_col: str) -> DataFrame:
    """Rows (id, fp, row), distinct (fp, first) and links between fp, as rows of :func:`classes`."""
    labels = work.keep(connected_components(links, Workspace(rows.sparkSession, "simhash-components")), "labels")
    placed = distinct.join(labels, distinct["fp"] == labels["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    placed = work.keep(placed, "placed")
    least = work.keep(placed.groupBy("component").agg(F.min("first").alias("stays")), "least")
    named = work.keep(placed.join(least, "component").select("fp", "stays"), "named")
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), "fp", "row", F.col("stays.id").alias("component_id"), (F.col("row") == F.col("stays.row")).alias("kept")
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    work = Workspace(docs.sparkSession, "drop-near-copies")
    found = work.keep(classes(docs, id_col, text_col), "classes")
    kept = found.filter("kept").select(F.col(id_col).alias("__id"))
    staying = docs.join(kept, F.col(id_col).eqNullSafe(F.col("__id")), "left_semi")
    repeated = found.groupBy(id_col).count().filter("count > 1")
    if repeated.isEmpty():
        return staying
    # An id that several rows share: the kept row's fingerprint tells which of them stays.
    keep = found.filter("kept").select(F.col(id_col).alias("__id"), F.col("fp").alias("__kept_fp"))
    marked = fingerprints(staying, text_col, "__fp")
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__kept_fp"))
    return marked.join(keep, same, "left_semi").dropDuplicates([id_col, "__fp"]).drop("__fp")
