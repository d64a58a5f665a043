"""A content-addressed store of token ids.

A rolling hash over a document's ids cuts them into chunks. The store holds each distinct
chunk once, under its SHA-256. A document's recipe lists its chunks and their Merkle root.
Recipes lie in ascending id order, in blocks. Blocks are the leaves of a Merkle tree as well:
a block's root is over its documents (id, place, size and root), a part's over its blocks, and
the store's over its parts. Reading works out the whole tree from the recipes and compares.

Files below the folder of a store (Parquet tables)
    chunks:   digest, data (ids as unsigned 16-bit integers: low bytes, then high bytes, Zstandard)
    recipes:  doc_id, start (ids of all documents before it), n_tokens, digests, root, part, block
    manifest: level (block, part or store), part, block, first_start, n_docs, n_tokens, root

Defined results
    ids have to be below 65 536, as they are stored in 16 bits; a larger one raises ValueError.
    null texts count as empty: such a document is its end token alone.
    null ids come first; repeated rows are stored once each, their chunks once for all.
    an empty table gives an empty store; other columns are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from lorekiln.functions.batches import release_memory, slices, small_batches
from lorekiln.llm.word_encoder import word_encoder
from lorekiln.sources.shared import Workspace

#: Ids that the rolling hash covers; cuts lie where MASK's bits are zero: a chunk has about 2000 ids.
REACH = 12
MASK = np.uint64(0x7FF << 44)
LEAST, MOST = 256, 16384
IDS = 1 << 16
BLOCK_DOCS = 1000
#: Documents and bytes of text that are tokenized at a time: their distinct words are looked up, and their
#: chunks stored, once.
SLICE_DOCS, SLICE_BYTES = 4000, 16 << 20

MANIFEST = ("level", "part", "block", "first_start", "n_docs", "n_tokens", "root")
PARTS = "doc_id bigint, n_tokens bigint, digests array<binary>, root binary, digest binary, data binary"


@cache
def _gears() -> np.ndarray:
    """A fixed random number per id."""
    return np.random.default_rng(1).integers(0, 1 << 64, IDS, np.uint64)


def rolling_hash(ids: np.ndarray) -> np.ndarray:
    """At each place, a hash of the ``REACH`` ids up to it."""
    gears = _gears()[ids]
    found = gears.copy()
    for back in range(1, REACH):
        found[back:] += gears[:-back] << np.uint64(back * 4)
    return found


def cuts(size: int, places: list[int]) -> list[int]:
    """Ends of the chunks of ``size`` ids; ``places``: where the rolling hash allows a cut."""
    ends, begin = [], 0
    for at in places:
        while at - begin > MOST:
            begin += MOST
            ends.append(begin)
        if at - begin >= LEAST:
            begin = at
            ends.append(at)
    while size - begin > MOST:
        begin += MOST
        ends.append(begin)
    if begin < size:
        ends.append(size)
    return ends


def digest_of(ids: np.ndarray) -> bytes:
    return hashlib.sha256(ids.astype("<u2").tobytes()).digest()


def packed(ids: np.ndarray) -> bytes:
    return zstandard.compress(ids.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, -1)
    return np.ascontiguousarray(planes.T).view("<u2").reshape(-1)


def merkle_root(digests: list[bytes]) -> bytes:
    """Pairwise SHA-256 up to one digest; an odd one moves up as it is."""
    level = list(digests)
    while len(level) > 1:
        level = [hashlib.sha256(b"".join(level[k : k + 2])).digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0] if level else b""


def _chunked(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Recipes (rows with ``digests``) and chunks (rows with ``digest``), each chunk once per slice."""
    end = np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, False)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for begin, texts in slices(batch.column(1), SLICE_BYTES):
                each = [np.concatenate([ids, end]) for ids in encoder.encode(texts)]
                sizes = np.array([len(ids) for ids in each])
                ends = np.cumsum(sizes)
                ids = np.concatenate(each)
                if ids.max() >= IDS:
                    raise ValueError(f"id {ids.max()} does not fit into 16 bits")
                # Windows that reach into the document before end before LEAST, where no cut is made.
                places = np.flatnonzero((rolling_hash(ids) & MASK) == 0) + 1
                bounds = np.searchsorted(places, np.concatenate([[0], ends]), side="right").tolist()
                recipes, chunks = [], {}
                for k, (size, stop) in enumerate(zip(sizes.tolist(), ends.tolist(), strict=True)):
                    first, digests, at = stop - size, [], 0
                    for to in cuts(size, (places[bounds[k] : bounds[k + 1]] - first).tolist()):
                        own = ids[first + at : first + to]
                        digests.append(digest_of(own))
                        if digests[-1] not in chunks:
                            chunks[digests[-1]] = packed(own)
                        at = to
                    recipes.append((names[begin + k], size, digests, merkle_root(digests)))
                doc, count, lists, roots = zip(*recipes, strict=True)
                n, m = len(recipes), len(chunks)
                yield pa.record_batch(
                    [
                        pa.array([*doc, *[None] * m], pa.int64()),
                        pa.array([*count, *[None] * m], pa.int64()),
                        pa.array([*lists, *[None] * m], pa.list_(pa.binary())),
                        pa.array([*roots, *[None] * m], pa.binary()),
                        pa.array([*[None] * n, *chunks], pa.binary()),
                        pa.array([*[None] * n, *chunks.values()], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "digests", "root", "digest", "data"],
                )
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PARTS)


def _placed(recipes: DataFrame, work: Workspace) -> DataFrame:
    """Recipes with ``start``, ``part`` and ``block``: prefix sums inside ranges of ids, and
    over the ranges, of which there are as many as shuffle partitions."""
    ranged = recipes.withColumn("row", F.monotonically_increasing_id()).repartitionByRange("doc_id", "row")
    ranged = work.keep(ranged.withColumn("part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    order = Window.partitionBy("part").orderBy("doc_id", "row")
    inside = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        ranged.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .withColumn("block", F.floor((F.row_number().over(order) - 1) / BLOCK_DOCS).cast("int"))
        .join(F.broadcast(offsets), "part")  # a row per shuffle partition
        .select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "digests", "root", "part", "block")
    )


@F.arrow_udf(BinaryType())
def _root_of(lists: pa.Array) -> pa.Array:
    return pa.array([merkle_root(digests) for digests in lists.to_pylist()], pa.binary())


def _manifest(recipes: DataFrame) -> DataFrame:
    """The Merkle tree over ``recipes``. A list has BLOCK_DOCS documents, the blocks of a shuffle
    partition's share, or all parts: as many as there are shuffle partitions."""

    def roots(leaf: Column) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.struct("first_start", leaf.alias("leaf")))), lambda r: r["leaf"])

    def level(rows: DataFrame, name: str, keys: list[str], leaf: Column) -> DataFrame:
        sums = [F.min("first_start").alias("first_start"), F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")]
        found = rows.groupBy(*keys).agg(*sums, roots(leaf).alias("leaves"))
        none = [F.lit(None).cast("int").alias(k) for k in ("part", "block") if k not in keys]
        return found.select(F.lit(name).alias("level"), *keys, *none, "first_start", "n_docs", "n_tokens", _root_of("leaves").alias("root")).select(*MANIFEST)

    leaf = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "first_start", "n_tokens", F.hex("root")), 256)
    documents = recipes.select("part", "block", F.col("start").alias("first_start"), F.lit(1).cast("long").alias("n_docs"), "n_tokens", F.unhex(leaf).alias("root"))
    blocks = level(documents, "block", ["part", "block"], F.col("root"))
    parts = level(blocks, "part", ["part"], F.col("root"))
    return blocks.union(parts).union(level(parts, "store", [], F.col("root")).filter("n_docs is not null"))


def write_store(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Tokenizes ``docs`` into a new store and returns its folder."""
    small_batches(docs.sparkSession, SLICE_DOCS)
    work = Workspace(docs.sparkSession, "token-store")
    both = work.keep(_chunked(docs, tokenizer, end_id, id_col, text_col), "chunked")
    chunks = both.filter("digest is not null").select("digest", "data")
    work.keep(chunks.groupBy("digest").agg(F.first("data").alias("data")), "chunks")
    recipes = work.keep(_placed(both.filter("digests is not null").select("doc_id", "n_tokens", "digests", "root"), work), "recipes")
    work.drop("chunked")
    work.drop("ranged")
    work.keep(_manifest(recipes), "manifest")
    return work.root


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents from their chunks, which arrive together and in order."""
    now, ids, digests = None, [], []

    def document() -> tuple:
        doc_id, start, n_tokens, root = now
        if merkle_root(digests) != root:
            raise ValueError(f"the chunks of the document at {start} don't give its root")
        whole = np.concatenate(ids).astype("<u4")
        if len(whole) != n_tokens:
            raise ValueError(f"the document at {start} has {len(whole)} ids, not {n_tokens}")
        return doc_id, start, n_tokens, whole.tobytes()

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "start", "n_tokens", "ids"])

    for batch in batches:
        rows = []
        for doc_id, start, n_tokens, root, digest, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now is None or now[1] != start:
                if now is not None:
                    rows.append(document())
                now, ids, digests = (doc_id, start, n_tokens, root), [], []
            own = None if data is None else unpacked(data)
            if own is None or digest_of(own) != digest:
                raise ValueError(f"a chunk of the document at {start} is missing or damaged")
            ids.append(own)
            digests.append(digest)
        if rows:
            yield out(rows)
    if now is not None:
        yield out([document()])


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian unsigned 32-bit) of every document, read
    from the store. Recipes are checked against the manifest first, documents while they are
    put together against digests, roots and counts."""
    small_batches(spark)
    if damaged := damaged_blocks(spark, folder).limit(3).collect():
        raise ValueError(f"recipes and manifest don't agree: {[(r['level'], r['part'], r['block']) for r in damaged]}")
    recipes, chunks = spark.read.parquet(f"{folder}/recipes"), spark.read.parquet(f"{folder}/chunks")
    wanted = recipes.select("doc_id", "start", "n_tokens", "root", F.posexplode("digests").alias("at", "digest"))
    # Both sides are plain tables, so the partition of a chunk that many documents share can be split.
    found = wanted.join(chunks, "digest", "left")
    ordered = found.repartition("start").sortWithinPartitions("start", "at")
    return ordered.select("doc_id", "start", "n_tokens", "root", "digest", "data").mapInArrow(
        _assembled, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def damaged_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the manifest's tree that the recipes don't give again; none in a sound store."""
    manifest, again = spark.read.parquet(f"{folder}/manifest"), _manifest(spark.read.parquet(f"{folder}/recipes"))
    return manifest.exceptAll(again).union(again.exceptAll(manifest))
