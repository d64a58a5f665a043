from __future__ import annotations

import random
import re

import pytest
import zstandard
from pyspark.sql import functions as F

from lorekiln.llm import lang_id

VOCABULARY = {"aa": ["kala", "mula", "tika", "remo", "puli"], "bb": ["strach", "grund", "weiss", "pfand", "knopf"], "cc": ["queux", "elleion", "parait", "toujours", "chat"]}


def text_of(lang, rng, n=60):
    return " ".join("".join(rng.choices(VOCABULARY[lang], k=rng.randrange(1, 3))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    rows = [(k, text_of(lang, rng), lang) for k in range(900) for lang in [rng.choice(list(VOCABULARY))]]
    return spark.createDataFrame([*rows, (9000, None, "aa"), (9001, "no label", None)], "doc_id long, text string, lang string")


def test_held_out_accuracy(spark, labelled):
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    model = lang_id.fit(labelled.filter(~held))
    assert set(model.languages) == set(VOCABULARY)
    found = lang_id.identify(labelled.filter(held & F.col("text").isNotNull() & F.col("lang").isNotNull()).withColumn("score", F.lit("clash")), model).collect()
    assert len(found) > 200
    assert sum(r.found.lang == r.lang for r in found) / len(found) > 0.98
    assert all(0 <= r.found.score <= 1 for r in found)


def test_texts_without_a_language(spark, labelled):
    model = lang_id.fit(labelled)
    df = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? ²"), (4, "KALA! mula; 123 TIKA remo puli kalamula " * 3), (5, "kala mula " * 40_000)], "doc_id long, text string")
    found = {r.doc_id: r.found for r in lang_id.identify(df, model).collect()}
    assert all(tuple(found[k]) == ("und", 0.0, True) for k in (1, 2, 3))
    assert found[4].lang == "aa" and not found[4].rejected
    assert found[5].lang == "aa"


def test_narrow_margins_are_rejected(labelled):
    model = lang_id.fit(labelled)
    assert lang_id.classify("zzzz xxxx", model)[2]


def test_without_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = lang_id.fit(empty)
    assert lang_id.identify(empty, model).count() == 0
    assert lang_id.classify("some text", model) == ("und", 0.0, True)
    one = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    assert lang_id.classify("any", lang_id.fit(one)) == ("en", 1.0, False)


def test_ties_go_to_the_more_frequent_language():
    assert lang_id.classify("qq", lang_id.Model(("b", "a"), (b"same text", b"same text")))[0] == "b"


def test_sizes_of_whole_texts(spark, labelled):
    """Against a plain computation: one compression of each piece, dictionaries not prepared."""
    model, rng = lang_id.fit(labelled), random.Random(6)
    rows = [(k, text_of(rng.choice(list(VOCABULARY)), rng, rng.choice([1, 3, 60, 3000]))) for k in range(40)]
    for r in lang_id.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect():
        data = " ".join(re.findall(r"[^\W\d_]+", r.text.lower())).encode()
        sizes = []
        for name, dictionary in zip(model.languages, model.dictionaries, strict=True):
            content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=9)
            plain = zstandard.ZstdCompressor(level=9, dict_data=content, write_content_size=False, write_checksum=False)
            sizes.append((sum(len(plain.compress(data[at : at + 1000])) for at in range(0, len(data), 1000)), model.languages.index(name)))
        sizes.sort()
        assert tuple(r.found) == (model.languages[sizes[0][1]], 1 - sizes[0][0] / sizes[1][0], 1 - sizes[0][0] / sizes[1][0] < lang_id.MARGIN)


def test_copies_and_long_texts_leave_room_for_others(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "ktmn" for b in "aiou" for c in "lrs"]
    own = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 60))) for _ in range(200)]
    rows = [(t, "aa") for t in own] + [(f"queux {w} chat " * 20, "bb") for w in words[:30]]
    copies = spark.range(20 * 5000).selectExpr("concat('kala mula ', cast(id % 20 as string)) text", "'aa' lang")
    long = spark.createDataFrame([("zu lang " * 700_000, "cc")], "text string, lang string")
    model = lang_id.fit(spark.createDataFrame(rows, "text string, lang string").union(copies).union(long))
    held = dict(zip(model.languages, (len(d) for d in model.dictionaries), strict=True))
    assert set(held) == {"aa", "bb", "cc"} and min(held.values()) > 1000
    assert max(held.values()) <= lang_id.SAMPLE_PIECES * lang_id.PIECE_CHARACTERS
    fresh = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(200)]
    assert sum(lang_id.classify(t, model)[0] == "aa" for t in fresh) >= 197


def test_fewer_pieces_than_wanted_are_all_taken(spark):
    rows = [(f"{w} end", "cc") for w in ("queux", "chat")] * 50 + [("12345", "dd"), (None, "ee")]
    model = lang_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    held = dict(zip(model.languages, (d.decode() for d in model.dictionaries), strict=True))
    assert sorted(held["cc"].split()) == ["chat", "end", "end", "queux"] and held["dd"] == "" and "ee" not in held


def test_an_estimate_too_large_is_mended(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("concat('wort', cast(id as string), ' zahl') text", "'de' lang")
    monkeypatch.setattr(F, "approx_count_distinct", lambda c: F.count_distinct(c) * 1000)
    (data,) = lang_id.fit(rows, pieces=50).dictionaries
    assert data.decode().split().count("zahl") == 50
