"""Packing of token ids into windows by best-fit decreasing.

Overlong documents are cut into full windows first. What remains of each document goes,
longest first, to the open window with the tightest room, which a segment tree indexed by
remaining capacity finds. What lies in windows that stay too empty is placed once more, and now
a piece that fits nowhere is cut to fill the widest room, so that padding stays low whatever the
lengths are. Tasks pack their own documents; nothing is shuffled. A task holds ``HELD_TOKENS`` of
remainders and one slice of texts at most: then all of them are packed but for one window.

Defined results
    null texts count as empty: such a document is its end token alone.
    repeated rows are packed once each; ids of documents may be null or repeat.
    an empty table gives no pieces; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import release_memory, slices, small_batches
from lorekiln.llm.word_encoder import word_encoder

WINDOW = 1024
HELD_TOKENS = 4 << 20
#: Padding above which a window's pieces are cut up and packed anew.
SLACK = WINDOW // 20

PIECES = "doc_id bigint, start bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class Rooms:
    """A segment tree over capacities; a node tells whether an open window below has one."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.has = bytearray(2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        at = room + self.leaves
        while at and not self.has[at]:
            self.has[at] = 1
            at >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, window) with the smallest room of at least ``least``."""
        at, has = least + self.leaves, self.has
        if not has[at]:
            while at > 1 and (at & 1 or not has[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if has[2 * at] else 2 * at + 1
        return self._pop(at)

    def take_widest(self, least: int) -> tuple[int, int] | None:
        """(room, window) with the largest room, if that is ``least`` or more."""
        at = 1
        while at < self.leaves:
            at = 2 * at + self.has[2 * at + 1]
        return self._pop(at) if self.has[at] and at - self.leaves >= least else None

    def _pop(self, at: int) -> tuple[int, int]:
        has, room = self.has, at - self.leaves
        window = self.windows[room].pop()
        if not self.windows[room]:
            while at and not (at < self.leaves and (has[2 * at] or has[2 * at + 1])):
                has[at] = 0
                at >>= 1
        return room, window


def best_fit(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Indexes of ``sizes`` by window, best-fit decreasing."""
    rooms, packed = Rooms(window), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        room, at = rooms.take(sizes[k]) or (window, len(packed))
        if at == len(packed):
            packed.append([])
        packed[at].append(k)
        if room > sizes[k]:
            rooms.add(room - sizes[k], at)
    return packed


def padding(used: int, window: int = WINDOW) -> int:
    """A sequence is padded to the window, except at a power of two."""
    return 0 if used & (used - 1) == 0 else window - used


def best_fit_cut(pieces: list[tuple], window: int = WINDOW, least: int = SLACK) -> list[list[tuple]]:
    """Pieces (doc_id, start, ids, doc_tokens) by window, best-fit decreasing; one that fits
    nowhere is cut to fill the widest room of ``least`` or more, and what is left is placed next."""
    rooms, packed = Rooms(window), []
    for doc, start, ids, total in sorted(pieces, key=lambda p: -len(p[2])):
        while len(ids):
            room, at = rooms.take(len(ids)) or rooms.take_widest(least) or (window, len(packed))
            if at == len(packed):
                packed.append([])
            packed[at].append((doc, start, ids[:room], total))
            if room > len(ids):
                rooms.add(room - len(ids), at)
            start, ids = start + len(ids[:room]), ids[room:]
    return packed


def pack_pieces(pieces: list[tuple], last: bool) -> tuple[list[list[tuple]], list[tuple]]:
    """(sequences, pieces of one window at most that wait for more); none wait at the last call."""
    sequences, loose = [], []
    for members in best_fit([len(p[2]) for p in pieces]):
        chosen = [pieces[k] for k in members]
        if padding(sum(len(p[2]) for p in chosen)) > SLACK:
            loose += chosen
        else:
            sequences.append(chosen)
    sequences += (again := best_fit_cut(loose))
    if last or not again:
        return sequences, []
    emptiest = min(range(len(sequences) - len(again), len(sequences)), key=lambda k: sum(len(p[2]) for p in sequences[k]))
    return sequences[:emptiest] + sequences[emptiest + 1 :], sequences[emptiest]


def _rows(sequences: list[list[tuple]], first: int) -> pa.RecordBatch:
    rows = []
    for k, members in enumerate(sequences):
        offset = 0
        for doc, start, ids, total in members:
            rows.append((doc, start, ids.tobytes(), total, first + k, offset))
            offset += len(ids)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
    names = ["doc_id", "start", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per piece: doc_id, start, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. Sequence ids are unique, not gapless."""
    small_batches(docs.sparkSession)
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer, True)
        following = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []
        held = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for begin, texts in slices(batch.column(1)):
                full = []
                for doc, ids in zip(names[begin:], encoder.encode(texts), strict=False):
                    ids = np.concatenate([ids.astype("<u4"), end])
                    whole = len(ids) - len(ids) % WINDOW
                    full += [[(doc, at, ids[at : at + WINDOW], len(ids))] for at in range(0, whole, WINDOW)]
                    if whole < len(ids):
                        waiting.append((doc, whole, ids[whole:].copy(), len(ids)))
                        held += len(ids) - whole
                if full:
                    yield _rows(full, following)
                    following += len(full)
                if held > HELD_TOKENS:
                    packed, waiting = pack_pieces(waiting, last=False)
                    held = sum(len(p[2]) for p in waiting)  # less than a window
                    if packed:
                        yield _rows(packed, following)
                        following += len(packed)
        packed, _ = pack_pieces(waiting, last=True)
        if packed:
            yield _rows(packed, following)
        del packed, waiting
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)
