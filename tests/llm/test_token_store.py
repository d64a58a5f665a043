from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lorekiln.llm import token_store

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start string"


def rows_of():
    rng = random.Random(9)
    shared = " ".join(f"passage{rng.randrange(500)}" for _ in range(4000))
    rows = [(k, " ".join(f"word{rng.randrange(300)}" for _ in range(rng.randrange(80))), "s") for k in range(200)]
    rows += [(500 + k, f"own {k} " + shared, "s") for k in range(5)] + [(700 + k, "copy of one text", "s") for k in range(60)]
    return rows + [(-5, None, "s"), (800, "", "s"), (801, "İ Ünïcödé 日本", "s"), (802, "long " * 50_000, "s"), (803, "twice", "s"), (803, "twice", "s"), (None, "nobody", "s")]


def test_round_trip_in_id_order(spark):
    rows = rows_of()
    folder = token_store.write_store(spark.createDataFrame(rows, SCHEMA).repartition(5), PATH)
    found = token_store.read_documents(spark, folder).select("*", F.crc32("ids").alias("crc")).collect()
    library, at = Tokenizer.from_file(PATH), 0
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.crc) for r in found), key=lambda r: r[1])
    wanted = []
    for k, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        wanted.append((k, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == wanted
    chunks = spark.read.parquet(f"{folder}/chunks")
    assert chunks.count() == chunks.select("digest").distinct().count()
    # The shared passage is stored once: its chunks are found again behind different beginnings.
    stored = sum(len(token_store.unpacked(r.data)) for r in chunks.collect())
    assert stored < 0.7 * at
    assert token_store.damaged_blocks(spark, folder).count() == 0
    manifest = spark.read.parquet(f"{folder}/manifest")
    assert {r.level: r.n for r in manifest.groupBy("level").agg(F.sum("n_docs").alias("n")).collect()} == dict.fromkeys(("block", "part", "store"), len(rows))
    tree = {level: sorted(manifest.filter(F.col("level") == level).collect(), key=lambda r: r.first_start) for level in ("block", "part", "store")}
    for part in tree["part"]:
        assert part.root == token_store.merkle_root([b.root for b in tree["block"] if b.part == part.part])
    assert tree["store"][0].root == token_store.merkle_root([p.root for p in tree["part"]])


def test_damage_is_found(spark):
    folder = token_store.write_store(spark.createDataFrame([(1, "some text", "s"), (2, "other", "s")], SCHEMA), PATH)
    chunks = spark.read.parquet(f"{folder}/chunks").collect()
    wrong = token_store.packed(np.array([1, 2, 3]))
    spark.createDataFrame([(c.digest, bytearray(wrong)) for c in chunks], "digest binary, data binary").write.mode("overwrite").parquet(f"{folder}/chunks")
    with pytest.raises(Exception, match="missing or damaged"):
        token_store.read_documents(spark, folder).collect()


@pytest.mark.parametrize("change", ["doc_id <> 2", "doc_id <> 1", "doc_id is not null"])
def test_lost_or_changed_recipes_are_found(spark, monkeypatch, change):
    monkeypatch.setattr(token_store, "BLOCK_DOCS", 2)
    folder = token_store.write_store(spark.createDataFrame([(k, f"text {k % 2}", "s") for k in range(7)], SCHEMA), PATH)
    recipes = spark.read.parquet(f"{folder}/recipes")
    kept = recipes.filter(change) if "<>" in change else recipes.withColumn("start", F.col("start") + F.when(F.col("doc_id") == 3, 1).otherwise(0))
    rows = kept.collect()
    spark.createDataFrame(rows, recipes.schema).write.mode("overwrite").parquet(f"{folder}/recipes")
    with pytest.raises(ValueError, match="don't agree"):
        token_store.read_documents(spark, folder)


def test_cuts_and_roots():
    assert token_store.cuts(10, []) == [10]
    assert token_store.cuts(token_store.MOST * 2 + 5, []) == [token_store.MOST, 2 * token_store.MOST, 2 * token_store.MOST + 5]
    assert token_store.cuts(1000, [10, 300, 310, 900]) == [300, 900, 1000]
    assert token_store.merkle_root([b"a"]) == b"a"
    assert token_store.merkle_root([b"a", b"b"]) != token_store.merkle_root([b"b", b"a"])


def test_chunks_follow_content_not_place():
    ids = np.random.default_rng(2).integers(0, 49_000, 20_000).astype(np.uint32)
    moved = np.concatenate([np.arange(777, dtype=np.uint32), ids])

    def chunks(a):
        places = (np.flatnonzero((token_store.rolling_hash(a) & token_store.MASK) == 0) + 1).tolist()
        ends = token_store.cuts(len(a), places)
        return {a[x:y].tobytes() for x, y in zip([0, *ends], ends, strict=False)}

    assert len(chunks(ids) & chunks(moved)) >= len(chunks(ids)) - 3


def test_empty_table(spark):
    folder = token_store.write_store(spark.createDataFrame([], SCHEMA), PATH)
    assert token_store.read_documents(spark, folder).count() == 0


def test_copies_far_apart_in_a_slice_give_their_chunks_once(spark):
    rng = random.Random(4)
    text = [" ".join(f"w{rng.randrange(900)}" for _ in range(600_000)) for _ in range(2)]
    docs = spark.createDataFrame([(1, text[0]), (2, text[1]), (3, text[0])], "doc_id long, text string").coalesce(1)
    digests = token_store._chunked(docs, PATH, 1, "doc_id", "text").filter("digest is not null").select("digest")
    assert digests.count() <= digests.distinct().count() + 1  # beyond 4 MB, copies were stored again
