from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lorekiln.llm import simhash_dedup

SCHEMA = "doc_id long, text string, fp string"


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def rows_of():
    rng = random.Random(11)
    base = [f"W{rng.randrange(4000)}ä" for _ in range(400)]
    rows = [(k, " ".join(rng.choices(base, k=rng.randrange(200))), "x") for k in range(150)]
    for k in range(200, 320):
        words = list(base)
        words[rng.randrange(400)] = f"changed{k}"
        rows.append((k, " ".join(words), "x"))
    rows += [(400 + k, " ".join(base), "x") for k in range(40)]
    return rows + [(500, None, "x"), (501, "", "x"), (502, " \n ", "x"), (503, "one two", "x"), (504, "ONE  TWO", "x"), (505, "w " * 60_000, "x"), (506, "twice a b c d", "x"), (506, "twice a b c d", "x"), (None, "one two", "x")]


def brute_force(rows):
    fps = np.array([plain_fingerprint(t) for _, t, _ in rows], np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4
    out = []
    for k in range(len(rows)):
        seen = near[k]
        while True:
            grown = near[seen].any(0)
            if (grown == seen).all():
                break
            seen = grown
        ids = [rows[j][0] for j in np.flatnonzero(seen) if rows[j][0] is not None]
        out.append((rows[k][0], f"{int(fps[k]):016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("homes, many", [(4096, 1 << 26), (3, 1 << 26), (4096, 1), (3, 1)])
def test_matches_brute_force(spark, monkeypatch, homes, many):
    monkeypatch.setattr(simhash_dedup, "HOMES", homes)
    monkeypatch.setattr(simhash_dedup, "MANY", many)
    rows = rows_of()
    found = simhash_dedup.classes(spark.createDataFrame(rows, SCHEMA).repartition(4))
    found = found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0"), "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == brute_force(rows)


def test_one_of_each_component_stays(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA)
    kept = simhash_dedup.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in brute_force(rows)})


@pytest.mark.parametrize("layout", [simhash_dedup.THREE_BLOCKS, simhash_dedup.TWO_BLOCKS])
def test_anchors_cover(layout):
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 1 << 64, 40, np.uint64)
    for block, (first, bits) in enumerate(layout.blocks):
        home, *_ = simhash_dedup.anchors(fps, layout, block)
        near = [0, *(1 << k for k in range(bits))]
        if layout.threshold == 2:
            near += [(1 << a) ^ (1 << b) for a, b in rng.integers(0, bits, (150, 2)).tolist()]
        for flip in near:
            _, rows, at = simhash_dedup.anchors(fps ^ np.uint64(flip << first), layout, block)
            reached = set(zip(rows.tolist(), at.tolist(), strict=True))
            assert all((k, int(home[k])) in reached for k in range(len(fps)))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_dedup.classes(empty).count() == 0
    assert simhash_dedup.drop_near_copies(empty).count() == 0
