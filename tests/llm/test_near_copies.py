from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from lorekiln.llm import near_copies
from lorekiln.llm.stars import spanning_forest

SCHEMA = "doc_id long, text string"


def plain_set(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or {tuple(words)}


def brute_force(rows):
    """(component of each row, pairs at 0.8 or more)."""
    every = [plain_set(t) for _, t in rows]
    label, pairs = list(range(len(rows))), 0
    for k in range(len(rows)):
        for j in range(k):
            if len(every[k] & every[j]) >= 0.8 * len(every[k] | every[j]):
                pairs += 1
                a, b = label[k], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for (doc_id, _), x in zip(rows, label, strict=True):
        if doc_id is not None:
            least[x] = min(doc_id, least.get(x, doc_id))
    return [least.get(x) for x in label], pairs


def rows_of():
    rng = random.Random(3)
    rows = []
    for group in range(25):
        base = [f"W{rng.randrange(5000)}ä" for _ in range(rng.randrange(60, 400))]
        for changes in (0, 1, 1, 2, 3, 4):
            words = list(base)
            for _ in range(changes * len(words) // 200 + bool(changes)):
                words[rng.randrange(len(words))] = f"changed{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    return [*rows, (900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "ONE  TWO"), (905, "w " * 20_000), (None, "one two"), (906, "p q r s t u"), (906, "p q r s t u"), (907, "a b"), (907, rows[0][1])]


@pytest.mark.parametrize("homes", [4096, 8])
def test_matches_brute_force_jaccard(spark, monkeypatch, homes):
    monkeypatch.setattr(near_copies, "HOMES", homes)
    monkeypatch.setattr(near_copies, "SEEN", 2)
    rows = rows_of()
    wanted, pairs = brute_force(rows)
    assert pairs > 100
    found = near_copies.classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=repr) == sorted(zip((k for k, _ in rows), wanted, strict=True), key=repr)


def templated(pages, rng):
    """Pages of one template, two and two alike beyond it: pairs at 0.86, others at 0.78."""
    common = [f"t{rng.randrange(10**6)}" for _ in range(500)]
    rows = []
    for page in range(pages):
        if page % 2 == 0:
            own = [f"p{rng.randrange(10**6)}" for _ in range(28)]
        words = common + own + [f"q{rng.randrange(10**6)}" for _ in range(43)]
        rows.append((page, " ".join(words)))
    return rows


@pytest.mark.parametrize("crowd", [256, 4])
def test_pairs_of_a_template_are_kept_apart_and_together(spark, monkeypatch, crowd):
    """Nearness by 64 bits connects all pages of the template; only real pairs may be links."""
    monkeypatch.setattr(near_copies, "CROWD", crowd)
    rows = templated(160, random.Random(12))
    wanted, pairs = brute_force(rows)
    assert pairs >= 70
    found = near_copies.classes(spark.createDataFrame(rows, SCHEMA).repartition(4)).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found)) == sorted(zip((k for k, _ in rows), wanted, strict=True))


def test_stage_drops_all_near_copies(spark):
    rows = rows_of()
    kept = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert kept.columns == ["doc_id", "text"]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(brute_force(rows)[0]))


def test_empty_table(spark):
    assert near_copies.drop_near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def test_recall_by_similarity():
    """Pairs whose sets have a known similarity meet at an anchor as often as is worked out."""
    rng = np.random.default_rng(5)
    blocks = near_copies.blocks_of(1000, 0.8, 0.99)
    for similarity in (0.8, 0.85, 0.9):
        shared = round(400 * 2 * similarity / (1 + similarity))
        met = 0
        for _ in range(60):
            own = rng.integers(0, 1 << 64, 800 - shared, np.uint64)
            pair = np.stack([near_copies.signature(own[:400]), near_copies.signature(own[400 - shared :])])
            met += any(len(set(near_copies.anchors(pair, k, chosen).tolist())) == 1 for k, chosen in enumerate(blocks))
        assert met >= 56


def test_more_documents_have_larger_blocks():
    few, many = near_copies.blocks_of(1 << 20, 0.8, 0.99), near_copies.blocks_of(1 << 30, 0.8, 0.99)
    assert many.shape[1] - few.shape[1] == 6 and len(many) > len(few)


def test_spanning_forest():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 60, 500), rng.integers(0, 60, 500)
    weight = rng.integers(0, 9, 500)
    kept = spanning_forest(np.append(a, [100, 101]), np.append(b, [101, 102]), np.append(weight, [1, 1]), 5)
    assert {500, 501} <= set(kept.tolist()) and len(kept) <= 61

    def total(links):
        label, size, count = list(range(103)), 0, 0
        for k in sorted(links, key=lambda k: weight[k]):
            x, y = label[a[k]], label[b[k]]
            if x != y:
                label, size, count = [x if z == y else z for z in label], size + weight[k], count + 1
        return size, count

    assert total(range(500)) == total([k for k in kept.tolist() if k < 500])


def test_a_crowd_is_connected_as_by_all_pairs():
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 4)
    for n in (10, 700):
        noise = np.bitwise_or.reduce([np.int64(1) << rng.integers(0, 62, n) for _ in range(6)])
        rows = np.stack([np.arange(n), centres[rng.integers(0, 4, n)] ^ noise], axis=1)
        pairs = near_copies.connecting(rows, 9)
        apart = np.bitwise_count((pairs[:, 0, 1] ^ pairs[:, 1, 1]).view(np.uint64))
        assert (apart <= 9).all() and len(pairs) < 2 * n

        def parts(a, b):
            label = list(range(n))
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                x, y = label[x], label[y]
                if x != y:
                    label = [x if z == y else z for z in label]
            return label

        every = np.bitwise_count((rows[:, None, 1] ^ rows[None, :, 1]).view(np.uint64)) <= 9
        wanted, found = parts(*np.nonzero(np.triu(every, 1))), parts(pairs[:, 0, 0], pairs[:, 1, 0])
        assert len(set(zip(wanted, found, strict=True))) == len(set(wanted)) == len(set(found))


def test_visitors_meet_all_members_over_batches():
    """A part's members are held over batches; a new part begins anew."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 1 << 63, 200, np.uint64))
    like, other = np.sort(np.concatenate([base[20:], base[:1]])), np.unique(rng.integers(0, 1 << 63, 200, np.uint64))
    rows = [(1, False, 10, base), (1, False, 11, other), (1, True, 12, like), (2, False, 13, other), (2, True, 14, like)]

    def batch(some):
        group, visits, node, sets = zip(*some, strict=True)
        fps = near_copies._lists([near_copies.signature(s) for s in sets])
        return pa.record_batch([pa.array(group), pa.array(visits), pa.array(node), fps, pa.array([s.tobytes() for s in sets])], ["group", "visits", "node", "fp", "hashes"])

    run = near_copies._compared(0.8, near_copies.BITS)
    for cut in (1, 2, 5):
        found = [r for b in run(iter([batch(rows[:cut]), *([batch(rows[cut:])] if cut < 5 else [])])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert found == [(12, 10)]


def test_a_guest_of_many_parts_at_an_anchor_is_one_row():
    """A component of 40 parts and 30 guests that are near all of it make 30 rows, not 1200."""
    rows = [(1, False, node, *[7] * near_copies.WORDS, 0, 40, node % 40) for node in range(80)]
    rows += [(1, False, node, *[7] * near_copies.WORDS, node, 1, 0) for node in range(100, 130)]
    names = ["group", "visits", "node", *near_copies._PARTS, "label", "parts", "deal_of"]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names)
    found = [r for b in near_copies._proposed(0, False)(iter([batch])) for r in b.to_pylist()]
    of_component = [r for r in found if r["label"] == 0]
    assert sorted(r["node"] for r in of_component) == list(range(100, 130))
    assert all(r["deals"] == list(range(40)) for r in of_component)


def test_few_rows_per_document_go_to_anchors():
    """At 30 GB, 14 million documents, as at fewer; a pair at the threshold still meets."""
    blocks = near_copies.blocks_of(14_000_000, 0.8, 0.99)
    assert len(blocks) <= 60
    assert 1 - (1 - near_copies.meeting_chance(0.8, blocks.shape[1] - near_copies.CODE_BITS)) ** len(blocks) >= 0.99


def test_texts_are_picked_by_a_bitmap_of_their_ids(spark):
    docs = spark.range(20_000).selectExpr("if(id = 5, null, id) AS id", "string(id) AS text")
    wanted = docs.filter("id IS NULL OR id % 97 = 3")
    found = near_copies.picked(docs, "id", near_copies.bitmap(wanted, "id")).filter("__picked")
    assert wanted.exceptAll(found.drop("__picked")).isEmpty()
    assert found.count() < 1.05 * wanted.count()
    assert near_copies.picked(docs, "id", near_copies.bitmap(wanted.limit(0), "id")).filter("__picked").isEmpty()


def test_sets_are_worked_out_for_picked_texts_only(spark):
    """A filter on the function's result would be moved below the choice of texts."""
    docs = spark.range(100).selectExpr("id", "string(id) AS text")
    texts = near_copies.picked(docs, "id", near_copies.bitmap(docs.filter("id < 3"), "id")).filter("__picked")
    sets = near_copies._with_sets(texts, "text", 5).join(docs.selectExpr("array(id) AS fp"), "fp")
    plan = sets._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert min(k for k, line in enumerate(plan) if "ArrowEvalPython" in line) < min(k for k, line in enumerate(plan) if "Join LeftOuter" in line)
