"""Near copies by Jaccard similarity of word shingles, found by wide SimHash fingerprints.

At a similarity of 0.8, two 64-bit fingerprints differ in about 10 bits, for which no code has
few anchors. So a text gets 512 bits here, and many blocks of bits drawn from them. In each
block the anchors are a perfect Hamming code with all values of the bits beyond it; a block's
threshold is 0, so a fingerprint goes to the one anchor within the covering radius. As many
blocks are drawn as a pair at the threshold needs to meet with the probability ``recall``.

Who meets at an anchor is compared by 192 bits, and the pairs that remain by all 512. Those that are
not clearly below the threshold are compared by their whole shingle sets, every one of them, so a
link is a real one. Equal fingerprints are one row from the start. Texts are never shuffled for
their sets: a bitmap of fixed size over the hashes of the wanted ids picks them where they are read,
and the fingerprint tells which of the picked ones are meant.

This happens twice. The first turn takes a few of the blocks and passes on only a forest of the
nearest pairs per task; its links join large groups of near copies, which meet in any block. The
second takes all blocks, and only pairs whose ends are not yet in one component: what is joined
needs no more links, so a large group does not make its pairs again in every block. Components
are kept in parts of few members; a document that came near a part's member visits the part and
is compared there with all of it, so visits are rows, pairs are not. All that meet make visits: what
the first turn leaves out at a crowded anchor is made up for here.

Defined results
    null texts have no words; texts without words are copies of each other.
    null ids never name a component that has another id; repeated rows are copies.
    an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import release_memory, small_batches
from lorekiln.llm.simhash_dedup import HOMES, corrected, meetings, name_components, shingles, syndromes
from lorekiln.llm.stars import spanning_forest
from lorekiln.operators.graph import connected_components
from lorekiln.sources.shared import Workspace

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.99
BITS = 512
CODE_BITS = 15
#: Bits of a block beyond the code's at least; more where anchors would have over 512 documents.
#: A row per document and block is shuffled and a pair at an anchor is only compared, so blocks are
#: few and their bits too, until there are 2 ** 24 documents.
PLAIN_BITS, SHARING = 4, 512
#: Words of a fingerprint that go to the anchors.
WORDS = 3
#: Blocks of the first turn. At the threshold two texts meet in one of them with a chance of 7 in 10.
FIRST = 16
#: Members in a part of a component.
PART = 64
#: Rows of a group above which the first turn does not compare all its pairs.
CROWD = 1024
#: Bits of the bitmap that picks texts by their ids, and of its rows.
PICKED, PICKED_ROW = 1 << 25, 1 << 15
#: Rows at an anchor from which a task reports it. What no task reports has fewer rows than this
#: times the number of tasks and is not split; results are the same.
SEEN = 64

_RNG = np.random.default_rng(42)
_PARTS = [f"part{w}" for w in range(WORDS)]
_MASKS = _RNG.integers(0, 1 << 64, BITS // 64, np.uint64)
_LOW = np.uint64(0x0101010101010101)


def differing(similarity: float) -> float:
    """Share of bits in which fingerprints of sets with this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def meeting_chance(similarity: float, plain: int) -> float:
    """That two fingerprints have the same anchor in a block."""
    p, n = differing(similarity), CODE_BITS
    q = 1 - p
    code = q**n + 2 * n / (n + 1) * p * q ** (n - 1) + n * (n - 1) / (n + 1) * p * p * q ** (n - 2)
    return code * q**plain


def blocks_of(n: int, similarity: float, recall: float) -> np.ndarray:
    """For each block, the bits that it is made of; the first are the code's."""
    plain = max(PLAIN_BITS, math.ceil(math.log2(max(1, n) / SHARING)) - 11)
    count = math.ceil(math.log(1 - recall) / math.log(1 - meeting_chance(similarity, plain)))
    rng = np.random.default_rng(7)
    return np.array([rng.permutation(BITS)[: CODE_BITS + plain] for _ in range(count)])


def signature(hashes: np.ndarray) -> np.ndarray:
    """Majority bits over a set of hashes, each of which is spread over all bits."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 255 * 64):
        own = hashes[at : at + 255 * 64]
        words = (own[:, None] ^ _MASKS) * np.uint64(0x9E3779B97F4A7C15)
        words ^= words >> np.uint64(32)
        words *= np.uint64(0xD6E8FEB86659FD93)
        words ^= words >> np.uint64(29)
        words = np.concatenate([words, np.zeros((-len(words) % 255, len(_MASKS)), np.uint64)]).reshape(-1, 255, len(_MASKS))
        # Byte lanes: 255 rows at most, so no lane runs over.
        lanes = [(words >> np.uint64(bit) & _LOW).sum(1).view(np.uint8).reshape(-1, BITS // 8).sum(0, dtype=np.int64) for bit in range(8)]
        counts += np.stack(lanes, axis=1).reshape(-1)
    return np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)


def _lists(fps: list[np.ndarray]) -> pa.ListArray:
    words = BITS // 64
    rows = np.concatenate([np.zeros(0, np.int64), *fps])
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) + 1, words), pa.int32()), pa.array(rows))


def signatures(docs: DataFrame, text_col: str, shingle: int, out: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as an array of 64-bit integers."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<bigint>")
    def of(texts: pa.Array) -> pa.Array:
        return _lists([signature(np.unique(shingles(t.as_py(), shingle))) for t in texts])

    return docs.withColumn(out, of(F.col(text_col)))


def _with_sets(docs: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(fp, hashes) of ``docs``: one function for both, so that a task has one Python worker."""

    @F.arrow_udf("struct<fp: array<bigint>, hashes: binary>")
    def of(texts: pa.Array) -> pa.Array:
        sets = [np.unique(shingles(t.as_py(), shingle)) for t in texts]
        return pa.StructArray.from_arrays([_lists(list(map(signature, sets))), pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "hashes"])

    # Else a filter on its result is moved before the choice of documents, and it runs on all of them.
    return docs.select(of.asNondeterministic()(F.col(text_col)).alias("found")).select("found.fp", "found.hashes")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, BITS // 64)


def anchors(fps: np.ndarray, block: int, chosen: np.ndarray) -> np.ndarray:
    """The anchor of each fingerprint in one block. Anchors carry the block."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")[:, chosen]
    value = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(len(chosen), dtype=np.uint64))
    return (corrected(value, syndromes(value, CODE_BITS)) | np.uint64(block << 48)).view(np.int64)


def _crowded(blocks: np.ndarray, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors that a task's fingerprints crowd; one with many rows is such in some task."""
        parts = [_matrix(b.column(1)) for b in batches if b.num_rows]
        fps = np.concatenate(parts) if parts else np.zeros((0, BITS // 64), np.int64)
        for k, chosen in enumerate(blocks if len(fps) >= least else []):
            at, counts = np.unique(anchors(fps, k, chosen), return_counts=True)
            many = counts >= least
            yield pa.record_batch([pa.array(at[many]), pa.array(counts[many])], ["anchor", "n"])

    return run


def _sent(blocks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _matrix(batch.column(1))
            for k, chosen in enumerate(blocks):
                words = [pa.array(fps[:, w].copy()) for w in range(WORDS)]
                columns = [pa.array(anchors(fps, k, chosen)), batch.column(0), *words, *batch.columns[2:]]
                yield pa.record_batch(columns, ["anchor", "node", *_PARTS, "label", "parts", "deal_of"])
        release_memory()

    return run


def apart_by(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of the words in the last dimension."""
    return sum(np.bitwise_count((a[..., w] ^ b[..., w]).view(np.uint64)).astype(np.int16) for w in range(a.shape[-1]))


def connecting(rows: np.ndarray, most: int, labels: np.ndarray | None = None, words: int = 1) -> np.ndarray:
    """Of rows (node, part, ...), a part of ``words`` columns, pairs that connect all that are connected by differing in
    ``most`` bits; rows with one label are connected from the start. What is reached already is
    not compared again, so a crowd of like rows costs little more than one look at each. Clear
    likeness goes first, so that few pairs are doubtful."""
    parts, found = rows[:, 1 : 1 + words].copy(), []
    label = np.arange(len(rows)) if labels is None else np.unique(labels, return_inverse=True)[1]
    for limit in (most // 2, most):
        waiting = np.ones(len(rows), bool)
        for head in np.unique(label).tolist():
            own = np.flatnonzero((label == head) & waiting)
            waiting[own] = False
            reached, at = own.tolist(), 0
            while at < len(reached) and waiting.any():
                some = np.array(reached[at : at + (64 if at else 1)])
                at += len(some)
                others = np.flatnonzero(waiting)
                apart = apart_by(parts[some][:, None], parts[others])
                best = apart.argmin(0)
                near = apart[best, np.arange(len(others))] <= limit
                if not near.any():
                    continue
                left, right = some[best[near]], others[near]
                found.append(np.stack([rows[right], rows[left]], axis=1))
                joined = np.flatnonzero(np.isin(label, label[right]) & waiting)
                label[joined] = head
                waiting[joined] = False
                reached += joined.tolist()
    return np.concatenate(found) if found else np.zeros((0, 2, rows.shape[1]), rows.dtype)


def _proposed(most: int, forest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, parts, deal = range(1 + WORDS, 4 + WORDS)
        words = slice(1, 1 + WORDS)

        def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (apart_by(a[:, words], b[:, words]) <= most) & (a[:, label] != b[:, label])

        for pairs in meetings(batches, near, True, CROWD if forest else None, lambda rows: connecting(rows, most, rows[:, label], WORDS)):
            if forest:
                a, b = pairs[:, 0, 0], pairs[:, 1, 0]
                keep = spanning_forest(a, b, apart_by(pairs[:, 0, words], pairs[:, 1, words]), 0)
                yield pa.record_batch([pa.array(np.maximum(a, b)[keep]), pa.array(np.minimum(a, b)[keep])], ["src", "dst"])
            else:
                # The smaller component visits a part of the larger one.
                a, b = pairs[:, 0], pairs[:, 1]
                at_left = ((a[:, parts] > b[:, parts]) | (a[:, parts] == b[:, parts]) & (a[:, label] < b[:, label]))[:, None]
                home, guest = np.where(at_left, a, b), np.where(at_left, b, a)
                found = np.unique(np.stack([guest[:, 0], home[:, label], home[:, deal]], axis=1), axis=0)
                # A guest that meets many parts of a component at an anchor is one row.
                begins = np.flatnonzero(np.append(True, (found[1:, :2] != found[:-1, :2]).any(1)))
                deals = pa.ListArray.from_arrays(pa.array(np.append(begins, len(found)), pa.int32()), pa.array(found[:, 2].copy()))
                yield pa.record_batch([pa.array(found[begins, 0]), pa.array(found[begins, 1]), deals], ["node", "label", "deals"])
        release_memory()

    return run


def propose(labelled: DataFrame, blocks: np.ndarray, most: int, forest: bool, work: Workspace) -> DataFrame:
    """Of ``node`` that met at an anchor, have different labels and differ in ``most`` of the
    bits that are sent: with ``forest``, pairs (src, dst) that connect all of a batch; else visits (node,
    label, deal) of one to the other's part ``deal`` of component ``label``."""
    fps = labelled.select("node", "fp", "label", "parts", F.col("deal").alias("deal_of"))
    crowded = fps.mapInArrow(_crowded(blocks, SEEN), "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    crowded = work.keep(crowded.filter(F.col("n") > HOMES).select("anchor", F.ceil(F.col("n") / HOMES).cast("int").alias("tasks")), "crowded")
    sent = fps.mapInArrow(_sent(blocks), ", ".join(f"{c} bigint" for c in ["anchor", "node", *_PARTS, "label", "parts", "deal_of"])).withColumn("deal", F.lit(0)).withColumn("visits", F.lit(False))
    if not crowded.isEmpty():
        # Documents at a crowded anchor are dealt; each meets its own deal and the lower ones.
        own = F.coalesce(F.pmod(F.xxhash64("node"), F.col("tasks")).cast("int"), F.lit(0))
        sent = sent.drop("deal", "visits").join(crowded, "anchor", "left").withColumn("own", own).withColumn("deal", F.explode(F.sequence(F.lit(0), "own")))
        sent = sent.withColumn("visits", F.col("deal") < F.col("own"))
    dealt = sent.select(F.xxhash64("anchor", "deal").alias("group"), "visits", "node", *_PARTS, "label", "parts", "deal_of").repartition("group").sortWithinPartitions("group", "visits")
    if forest:
        return dealt.mapInArrow(_proposed(most, forest), "src bigint, dst bigint").distinct()
    met = dealt.mapInArrow(_proposed(most, forest), "node bigint, label bigint, deals array<bigint>")
    deals = F.array_distinct(F.flatten(F.collect_set("deals")))
    return met.groupBy("node", "label").agg(deals.alias("deals")).select("node", "label", F.explode("deals").alias("deal"))


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of sorted arrays without repeats."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared) if len(both) else 1.0


def bitmap(ids: DataFrame, id_col: str) -> DataFrame:
    """(__row, __bits): a bit is set for the hash of each id; of fixed size, however many ids."""
    at = F.pmod(F.xxhash64(id_col), F.lit(PICKED))
    return ids.groupBy((at / PICKED_ROW).cast("int").alias("__row")).agg(F.bitmap_construct_agg(at % PICKED_ROW).alias("__bits"))


def picked(docs: DataFrame, id_col: str, bits: DataFrame) -> DataFrame:
    """``docs`` with ``__picked``: whether the bit of the id is set. It is for each id of the
    bitmap, null included, and for few others."""
    at = F.pmod(F.xxhash64(id_col), F.lit(PICKED))
    bit = (at % PICKED_ROW).cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.join(F.broadcast(bits), (at / PICKED_ROW).cast("int") == F.col("__row"), "left")
    return found.select(*docs.columns, F.coalesce(F.getbit(byte, bit % 8) == 1, F.lit(False)).alias("__picked"))


def _sets(nodes: DataFrame, docs: DataFrame, distinct: DataFrame, shingle: int, work: Workspace) -> DataFrame:
    """(node, fp, hashes): the whole shingle sets of ``nodes``."""
    wanted = work.keep(distinct.join(nodes.distinct(), "node", "left_semi").select("node", "fp", F.col("first.id").alias("wanted_id")), "wanted")
    texts = picked(docs, "id", work.keep(bitmap(wanted, "wanted_id"), "picked")).filter("__picked")
    # The fingerprint tells which text a node stands for: ids may repeat, and others share a bit.
    sets = _with_sets(texts, "text", shingle).join(wanted.select("node", "fp"), "fp")
    return work.keep(sets.groupBy("node").agg(F.first("fp").alias("fp"), F.first("hashes").alias("hashes")), "sets")


def _similar(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, shingle: int, similarity: float, work: Workspace) -> DataFrame:
    """Those of ``pairs`` (src, dst) whose whole shingle sets are similar enough."""

    @F.arrow_udf("double")
    def compared(left: pa.Array, right: pa.Array) -> pa.Array:
        sets = ((np.frombuffer(v, "<u8") for v in pair) for pair in zip(left.to_pylist(), right.to_pylist(), strict=True))
        return pa.array([jaccard(*pair) for pair in sets], pa.float64())

    sets = _sets(pairs.select(F.col("src").alias("node")).union(pairs.select(F.col("dst").alias("node"))), docs, distinct, shingle, work)
    left, right = sets.select(F.col("node").alias("src"), F.col("hashes").alias("l")), sets.select(F.col("node").alias("dst"), F.col("hashes").alias("r"))
    return pairs.join(left, "src").join(right, "dst").filter(compared("l", "r") >= similarity).select("src", "dst")


def _compared(similarity: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (group, visits, node, fp, hashes) sorted so that a part's members come first."""
        last, nodes, fps, sets = None, [], [], []
        for batch in batches:
            src, dst = [], []
            group, visits, ids = (batch.column(k).to_pylist() for k in range(3))
            wide = _matrix(batch.column(3))
            for k, hashes in enumerate(batch.column(4)):
                own = np.frombuffer(hashes.as_py(), "<u8")
                if group[k] != last:
                    last, nodes, fps, sets = group[k], [], [], []
                if not visits[k]:
                    nodes.append(ids[k]), fps.append(wide[k].copy()), sets.append(own)
                    continue
                apart = np.bitwise_count((np.array(fps) ^ wide[k]).view(np.uint64)).sum(1)
                found = [nodes[i] for i in np.flatnonzero(apart <= most).tolist() if jaccard(sets[i], own) >= similarity]
                src += [ids[k]] * len(found)
                dst += found
            yield pa.record_batch([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], ["src", "dst"])
        release_memory()

    return run


def _visited(labelled: DataFrame, blocks: np.ndarray, plain: DataFrame, shingle: int, similarity: float, work: Workspace) -> DataFrame:
    """(src, dst): links between different components, by comparing visitors with whole parts."""
    p = differing(similarity)
    visits = work.keep(propose(labelled, blocks, _with_error(64 * WORDS, p, 3), False, work), "visits")
    # A part with many visitors is copied, and these are dealt over its copies.
    homes = work.keep(visits.groupBy("label", "deal").agg(F.ceil(F.count("*") / HOMES).alias("copies")), "homes")
    members = labelled.join(homes, ["label", "deal"]).select("label", "deal", "node", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("copy"))
    guests = visits.join(homes, ["label", "deal"]).select("label", "deal", "node", F.pmod(F.xxhash64("node"), "copies").alias("copy"))
    present = work.keep(members.withColumn("visits", F.lit(False)).union(guests.withColumn("visits", F.lit(True))), "present")
    sets = _sets(present.select("node"), plain, labelled, shingle, work)
    rows = present.join(sets, "node").select(F.xxhash64("label", "deal", "copy").alias("group"), "visits", "node", "fp", "hashes")
    rows = rows.repartition("group").sortWithinPartitions("group", "visits")
    return work.keep(rows.mapInArrow(_compared(similarity, _with_error(BITS, p, 4)), "src bigint, dst bigint"), "links")


def _links(labelled: DataFrame, blocks: np.ndarray, plain: DataFrame, shingle: int, similarity: float, work: Workspace) -> DataFrame:
    """(src, dst): links that join most of what a large group of near copies holds."""
    p = differing(similarity)
    pairs = work.keep(propose(labelled, blocks, _with_error(64 * WORDS, p, 3), True, work), "pairs")
    left, right = (labelled.select(F.col("node").alias(end), F.col("fp").alias(f"{end}_fp")) for end in ("src", "dst"))
    apart = F.aggregate(F.zip_with("src_fp", "dst_fp", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda a, b: a + b)
    pairs = pairs.join(left, "src").join(right, "dst").select("src", "dst", apart.alias("apart"))
    pairs = work.keep(pairs.filter(F.col("apart") <= _with_error(BITS, p, 4)), "measured")
    return work.keep(_similar(pairs.select("src", "dst"), plain, labelled, shingle, similarity, work), "links")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """A row per document: its id, fp, component_id and row, a number of its own, and whether
    it is the one of its component that stays."""
    work = Workspace(docs.sparkSession, "near-copies")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = signatures(plain, "text", shingle).select("id", "fp", F.monotonically_increasing_id().alias("row"))
    rows = work.keep(rows, "rows")
    first = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row"))
    distinct = work.keep(rows.groupBy("fp").agg(first.alias("first")).withColumn("node", F.col("first.row")), "distinct")
    blocks = blocks_of(distinct.count(), similarity, recall)
    turn = Workspace(docs.sparkSession, "near-copies-first")
    alone = distinct.withColumns({"label": F.col("node"), "parts": F.lit(1).cast("bigint"), "deal": F.lit(0).cast("bigint")})
    links = _links(alone, blocks[:FIRST], plain, shingle, similarity, turn)
    known = work.keep(connected_components(links, Workspace(docs.sparkSession, "near-copies-known")), "known")
    parts = work.keep(known.groupBy(F.col("component").alias("label")).agg(F.ceil(F.count("*") / PART).alias("parts")), "parts")
    dealt = known.withColumnRenamed("component", "label").join(parts, "label").withColumn("deal", F.pmod(F.xxhash64("node"), "parts"))
    labelled = distinct.join(dealt, "node", "left").select(
        "node", "fp", "first", F.coalesce("label", "node").alias("label"), F.coalesce("parts", F.lit(1)).alias("parts"), F.coalesce("deal", F.lit(0)).alias("deal")
    )
    links = links.union(_visited(work.keep(labelled, "labelled"), blocks, plain, shingle, similarity, work))
    numbered = rows.join(distinct.select("fp", "node"), "fp").select("id", "row", F.col("node").alias("fp"))
    named = name_components(numbered, distinct.select(F.col("node").alias("fp"), "first"), links, work, id_col)
    return named.join(distinct.select(F.col("node").alias("node"), F.col("fp").alias("wide")), F.col("fp") == F.col("node")).select(
        id_col, F.col("wide").alias("fp"), "row", "component_id", "kept"
    )


def _with_error(bits: int, p: float, deviations: int) -> int:
    """Differing bits of a pair at the threshold, and that many standard deviations more."""
    return int(bits * p + deviations * math.sqrt(bits * p * (1 - p)))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns."""
    work = Workspace(docs.sparkSession, "drop-near-copies")
    found = work.keep(classes(docs, id_col, text_col, shingle, similarity, recall), "classes")
    kept = found.filter("kept").select(F.col(id_col).alias("__id"), F.col("fp").alias("__kept"))
    same = F.col(id_col).eqNullSafe(F.col("__id"))
    # Texts are shuffled only where an id may be one of those that go.
    marks = picked(docs, id_col, work.keep(bitmap(found.filter("not kept"), id_col), "picked"))
    staying = marks.filter("not __picked").union(marks.filter("__picked").join(kept, same, "left_semi")).drop("__picked")
    if found.groupBy(id_col).count().filter("count > 1").isEmpty():
        return staying
    # An id that several rows share: the kept row's fingerprint tells which of them stays.
    marked = signatures(staying, text_col, shingle, "__fp")
    return marked.join(kept, same & (F.col("__fp") == F.col("__kept")), "left_semi").dropDuplicates([id_col, "__fp"]).drop("__fp")
