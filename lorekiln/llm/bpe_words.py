"""Byte-level BPE over a global shuffle of distinct words.

Texts are cut into blocks. A block lists its distinct pre-tokens and, for each document, the
places of its pre-tokens in that list. The lists are dealt by a hash of the word, so that
each distinct word of the corpus is encoded once; the ids travel back to the blocks and are
put together by position. A word takes part once per block, however often it occurs, and
what a block sends to a group of words is one compressed row. Beyond ``MOST_GROUPS`` groups, a
group is split by ranges of blocks, so that the group of a word that every block has does not
grow with the corpus; such a word is encoded once per range.

Decoding looks ids up in the table of token bytes, whose size is the vocabulary's.

Defined results
    null and empty texts have no ids.
    repeated rows are encoded once each; ids of documents may be null or repeat.
    a text of any length is encoded whole; an empty table gives an empty result; other
    columns are left alone.

Blocks are made twice, once for their words and once for their positions, as the positions of
a corpus are large and texts are quickly read again. Both times a block has to be the same: its
words carry a digest, and a block that came out otherwise stops the job. Reading a table gives
the same blocks each time; write other inputs to a table first.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import small_batches
from lorekiln.llm.word_encoder import TOGETHER

#: Bytes of text in a block; bytes of a corpus per group of words; places in a row.
BLOCK_BYTES = 8 << 20
GROUP_BYTES = 16 << 20
LEAST_GROUPS, MOST_GROUPS = 64, 4096
ROW_PLACES = 1 << 20

DOCUMENTS = "block bigint, digest binary, doc_ids array<bigint>, counts array<bigint>, places binary"
WORDS = "block bigint, digest binary, words_group int, places binary, words binary"
ENCODED = "block bigint, digest binary, places binary, sizes binary, ids binary"


def _packed(values: np.ndarray) -> bytes:
    """Zstandard over the byte planes of unsigned integers, lowest bytes first."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _packed_words(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), "<u4", len(words)).tobytes()
    return zstandard.compress(len(words).to_bytes(8, "little") + sizes + b"".join(words), 3)


def _unpacked_words(data: bytes) -> pa.Array:
    raw = zstandard.decompress(data)
    n = int.from_bytes(raw[:8], "little")
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", n, 8))]).astype("<i4")
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw[8 + 4 * n :])])


@cache
def _pattern(pattern: str) -> regex.Pattern:
    return regex.compile(pattern)


def _spans(texts: pa.Array) -> pa.ListArray:
    """Texts cut before single spaces and line breaks, where the patterns of this family begin a
    pre-token; texts in which these are not single stay whole."""
    cut = pc.replace_substring(pc.replace_substring(texts, " ", "\x00 "), "\n", "\x00\n")
    together = pc.match_substring_regex(texts, TOGETHER)
    if not pc.any(together).as_py():
        return pc.split_pattern(cut, "\x00")
    lists = [[t] if whole else c.split("\x00") for t, c, whole in zip(texts.to_pylist(), cut.to_pylist(), together.to_pylist(), strict=True)]
    return pa.array(lists, pa.list_(pa.string()))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the slices [start, start + size) in a row, and where each slice ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total), ends


def block_parts(texts: pa.Array, pattern: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pre-tokens, place of each pre-token of all texts in a row, their number by
    text). Frequent pre-tokens have low places."""
    lists = _spans(pc.fill_null(texts, ""))
    bounds = lists.offsets.to_numpy()
    spans = lists.flatten().dictionary_encode()
    codes, distinct = spans.indices.to_numpy(), spans.dictionary
    find = _pattern(pattern).findall
    found = [find(text) for text in distinct.to_pylist()]
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    tokens = list(chain.from_iterable(found))
    del found
    words = pa.array(tokens, pa.string()).dictionary_encode()
    del tokens
    which = words.indices.to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    index, ends = _ragged(starts[codes], sizes[codes])
    places = which[index]
    order = np.argsort(-np.bincount(places, minlength=len(words.dictionary)), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    ends = np.concatenate([[0], ends])[bounds - bounds[0]]
    return words.dictionary.cast(pa.binary()).take(pa.array(order)).to_pylist(), rank[places], np.diff(ends)


def _batch(schema: dict[str, pa.DataType], *values) -> pa.RecordBatch:
    return pa.record_batch([pa.array([v], t) for v, t in zip(values, schema.values(), strict=True)], list(schema))


def _document_rows(block: int, ids: list, words: list[bytes], places: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The places of a block's documents, up to ROW_PLACES or one document in a row."""
    integers = pa.list_(pa.int64())
    schema = {"block": pa.int64(), "digest": pa.binary(), "doc_ids": integers, "counts": integers, "places": pa.binary()}
    ends, begin = np.cumsum(counts), 0
    while begin < len(ids):
        before = ends[begin - 1] if begin else 0
        to = max(begin + 1, int(np.searchsorted(ends, before + ROW_PLACES, side="right")))
        yield _batch(schema, block, _digest(words), ids[begin:to], counts[begin:to].tolist(), _packed(places[before : ends[to - 1]]))
        begin = to


def _word_rows(block: int, words: list[bytes], groups: int) -> Iterator[pa.RecordBatch]:
    """A block's distinct words, a row per group."""
    schema = {"block": pa.int64(), "digest": pa.binary(), "words_group": pa.int32(), "places": pa.binary(), "words": pa.binary()}
    group = np.fromiter((zlib.crc32(w) % groups for w in words), np.int64, len(words))
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1)).tolist()
    digest = _digest(words)
    for g in range(groups):
        if bounds[g] < bounds[g + 1]:
            own = order[bounds[g] : bounds[g + 1]]
            yield _batch(schema, block, digest, g, _packed(own), _packed_words([words[k] for k in own.tolist()]))


def _digest(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b"\xff".join(words))


def _blocks(docs: DataFrame, pattern: str, groups: int | None) -> DataFrame:
    """Rows of the blocks' documents, or with ``groups`` rows of their words."""

    def rows(block: int, ids: list, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        words, places, counts = block_parts(pa.concat_arrays(texts), pattern)
        if groups is None:
            yield from _document_rows(block, ids, words, places, counts)
        else:
            yield from _word_rows(block, words, groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            ids += batch.column(0).to_pylist()
            texts.append(batch.column(1))
            size += batch.column(1).nbytes
            if size >= BLOCK_BYTES:
                yield from rows(block, ids, texts)
                block, ids, texts, size = block + 1, [], [], 0
                pa.default_memory_pool().release_unused()
        if ids:
            yield from rows(block, ids, texts)

    return docs.mapInArrow(run, DOCUMENTS if groups is None else WORDS)


@cache
def _encoding(path: str):
    """Takes what it is given as one pre-token."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})


def _encoded(words: DataFrame, path: str, ranges: int) -> DataFrame:
    """Ids of every block's words; each distinct word is encoded once."""

    def run(table: pa.Table) -> pa.Table:
        lists = [_unpacked_words(w) for w in table["words"].to_pylist()]
        every = pa.concat_arrays(lists).dictionary_encode()
        encode = _encoding(path).encode_ordinary
        ids = pa.array([encode(w.decode()) for w in every.dictionary.to_pylist()], pa.list_(pa.uint32()))
        flat, bounds = ids.flatten().to_numpy(), ids.offsets.to_numpy().astype(np.int64)
        starts, sizes = bounds[:-1], np.diff(bounds)
        codes, at, out = every.indices.to_numpy(), 0, []
        for words_here in lists:
            own = codes[at : at + len(words_here)]
            index, _ = _ragged(starts[own], sizes[own])
            out.append((_packed(sizes[own]), _packed(flat[index])))
            at += len(words_here)
        sizes_out, ids_out = zip(*out, strict=True)
        return pa.table(
            {"block": table["block"], "digest": table["digest"], "places": table["places"], "sizes": pa.array(sizes_out, pa.binary()), "ids": pa.array(ids_out, pa.binary())}
        )

    dealt = words.withColumn("range", F.pmod(F.xxhash64("block"), F.lit(ranges)).cast("int"))
    return dealt.groupBy("words_group", "range").applyInArrow(run, ENCODED)


def _assembled(documents: pa.Table, words: pa.Table) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, token ids) of a block's documents: ids of their pre-tokens in order of position."""
    if len({*documents["digest"].to_pylist(), *words["digest"].to_pylist()}) > 1:
        raise ValueError("a block of documents was not read the same way twice; write the input to a table first")
    places = [_unpacked(p) for p in words["places"].to_pylist()]
    count = sum(map(len, places))
    sizes, starts, flat, held = np.zeros(count, np.int64), np.zeros(count, np.int64), [np.zeros(0, np.uint32)], 0
    for own, n, ids in zip(places, words["sizes"].to_pylist(), words["ids"].to_pylist(), strict=True):
        n = _unpacked(n).astype(np.int64)
        sizes[own], starts[own] = n, held + np.cumsum(n) - n
        flat.append(_unpacked(ids))
        held += len(flat[-1])
    flat = np.concatenate(flat)
    for ids, counts, packed in zip(documents["doc_ids"].to_pylist(), documents["counts"].to_pylist(), documents["places"].to_pylist(), strict=True):
        own = _unpacked(packed)
        index, ends = _ragged(starts[own], sizes[own])
        tokens = flat[index].astype("<u4")
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        yield from zip(ids, (tokens[a:b] for a, b in zip(bounds, bounds[1:], strict=False)), strict=True)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", round_trip: bool = False) -> DataFrame:
    """A row per document: doc_id, ids (little-endian unsigned 32-bit integers), and with
    ``round_trip`` decoded, the bytes that the ids stand for."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_GROUPS, -(-size // GROUP_BYTES))
    groups = min(parts, MOST_GROUPS)
    words = _blocks(rows, pattern, groups)

    def assemble(documents: pa.Table, encoded: pa.Table) -> pa.Table:
        out: dict[str, list] = {"doc_id": [], "ids": [], **({"decoded": []} if round_trip else {})}
        for doc_id, ids in _assembled(documents, encoded):
            out["doc_id"].append(doc_id)
            out["ids"].append(ids.tobytes())
            if round_trip:
                out["decoded"].append(bytes_of(ids, path))
        return pa.table([pa.array(c, pa.int64() if n == "doc_id" else pa.binary()) for n, c in out.items()], names=list(out))

    by_block = _blocks(rows, pattern, None).groupBy("block").cogroup(_encoded(words, path, -(-parts // groups)).groupBy("block"))
    return by_block.applyInArrow(assemble, "doc_id bigint, ids binary" + ", decoded binary" * round_trip)


@cache
def _token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all tokens in a row, where each begins, how many it has)."""
    with open(path, "rb") as lines:
        tokens = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    table = [tokens.get(k, b"") for k in range(max(tokens) + 1)]
    sizes = np.fromiter(map(len, table), np.int64, len(table))
    return np.frombuffer(b"".join(table), np.uint8), np.cumsum(sizes) - sizes, sizes


def bytes_of(ids: np.ndarray, path: str) -> bytes:
    data, starts, sizes = _token_bytes(path)
    index, _ = _ragged(starts[ids], sizes[ids])
    return data[index].tobytes()


def decoded(ids: Column, path: str) -> Column:
    """The bytes that a column of ids stands for."""

    @F.arrow_udf("binary")
    def of(column: pa.Array) -> pa.Array:
        return pa.array([None if v is None else bytes_of(np.frombuffer(v, "<u4"), path) for v in column.to_pylist()], pa.binary())

    return of(ids)
