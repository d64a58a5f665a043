from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lorekiln.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["Hello  world", None, "", " x ", "a\n\nb", "word " * 5000, "The quick, brown fox. " * 300, "\x00a", "é à\r\nq", "don't 12 345!?", "a ., b", "..,", "same", "same"]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def check(rows, texts, tokenizer):
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for k, t in texts}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for k, own in ids.items():
        whole = [i for r in sorted(pieces[k], key=lambda r: r.start) for i in np.frombuffer(r.ids, "<u4").tolist()]
        assert whole == own
        assert all(r.doc_tokens == len(own) for r in pieces[k])
    padding = 0
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += len(r.ids) // 4
        assert at <= packing.WINDOW
        padding += packing.padding(at)
    return padding / max(1, sum(map(len, ids.values())))


def test_round_trip(spark, tokenizer):
    rows = list(enumerate(TEXTS))
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, start long")
    check(packing.pack(df, PATH).collect(), rows, tokenizer)


def test_padding_stays_low_for_awkward_lengths(spark, tokenizer):
    rows = [(k, " the" * 599) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert check(packing.pack(df, PATH).collect(), rows, tokenizer) < 0.02


def test_empty_and_repeated(spark):
    schema = "doc_id long, text string"
    assert packing.pack(spark.createDataFrame([], schema), PATH).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], schema), PATH).collect()
    assert sorted((r.doc_id for r in twice), key=repr) == [1, 1, None]


def test_best_fit_matches_a_search_over_all_windows():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randint(1, 1024) for _ in range(rng.randint(0, 120))]
        rooms: list[int] = []
        for size in sorted(sizes, reverse=True):
            able = [k for k, room in enumerate(rooms) if room >= size]
            if able:
                rooms[min(able, key=lambda k: rooms[k])] -= size
            else:
                rooms.append(1024 - size)
        assert sorted(1024 - sum(sizes[k] for k in w) for w in packing.best_fit(sizes)) == sorted(rooms)


def pieces_of(sizes):
    return [(k, 0, np.full(size, k, "<u4"), size) for k, size in enumerate(sizes)]


@pytest.mark.parametrize("size", [600, 513, 1023, 300, 1])
def test_equal_remainders_do_not_pile_up(size):
    held, waiting, sequences, first = 0, [], [], 0
    for _ in range(20):
        fresh = [(first + k, 0, np.full(size, first + k, "<u4"), size) for k in range(200)]
        first += 200
        packed, waiting = packing.pack_pieces(waiting + fresh, last=False)
        held = max(held, sum(len(p[2]) for p in waiting))
        sequences += packed
    assert held < packing.WINDOW
    packed, none = packing.pack_pieces(waiting, last=True)
    sequences += packed
    assert not none and all(sum(len(p[2]) for p in s) <= packing.WINDOW for s in sequences)
    whole = {}
    for doc, start, ids, _ in (p for s in sequences for p in s):
        assert (ids == doc).all()
        whole.setdefault(doc, []).append((start, len(ids)))
    assert len(whole) == 4000
    for parts in whole.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at == size
    assert sum(packing.padding(sum(len(p[2]) for p in s)) for s in sequences) < 0.06 * 4000 * size + packing.WINDOW


def test_cut_pieces_leave_one_window_open():
    rng = random.Random(4)
    for _ in range(50):
        sizes = [rng.randint(1, 1024) for _ in range(rng.randint(1, 300))]
        used = [sum(len(p[2]) for p in s) for s in packing.best_fit_cut(pieces_of(sizes))]
        assert sum(used) == sum(sizes) and sum(u < packing.WINDOW - packing.SLACK for u in used) <= 1
