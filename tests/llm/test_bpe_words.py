from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from lorekiln.llm import bpe_words

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["a  b", "  x ", "a\n\nb", "a \n b", "tab\tx  y\t", "x y z", "\x00 a", "don't I'll 12 345,!? ..", "", "\n", " ", "é à\r\nq", "  ", "end\n", "a   b    c\n\n\n d", "　x", None, "same", "same"]


def texts():
    rng = random.Random(6)
    pieces = ["Hello", "world", ",", ".", " ", "\n", "ß", "日本", "😀", "1", "'s", "-", "\t", "\x00"]
    return ODD + ["".join(rng.choices(pieces, k=rng.randrange(1, 20))) for _ in range(400)] + ["word " * 30_000, "x" * 20_000 + " 日" * 5000]


def whole_texts():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("most_groups", [4096, 3])
def test_ids_are_the_library_s(spark, monkeypatch, most_groups):
    monkeypatch.setattr(bpe_words, "ROW_PLACES", 100)
    monkeypatch.setattr(bpe_words, "MOST_GROUPS", most_groups)
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clash")).repartition(3, "doc_id")
    found = bpe_words.encode(df, PATH, PATTERN, round_trip=True).collect()
    library = whole_texts()
    assert sorted(r.doc_id for r in found) == [k for k, _ in rows]
    for r in found:
        text = rows[r.doc_id][1] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert bytes(r.decoded) == text.encode()


def test_decoding_column(spark):
    df = spark.createDataFrame([(1, "héllo"), (2, ""), (None, None)], "doc_id long, text string")
    found = bpe_words.encode(df, PATH, PATTERN).withColumn("back", bpe_words.decoded(F.col("ids"), PATH)).collect()
    assert sorted(bytes(r.back).decode() for r in found) == ["", "", "héllo"]


def test_blocks_that_differ_are_refused():
    words, places, counts = bpe_words.block_parts(pa.array(["a b", "c"]), PATTERN)
    documents = pa.Table.from_batches(list(bpe_words._document_rows(0, [1, 2], words, places, counts)))
    other = pa.Table.from_batches(list(bpe_words._word_rows(0, [*words, b"more"], 4)))
    with pytest.raises(ValueError, match="twice"):
        list(bpe_words._assembled(documents, other))


def test_empty_table(spark):
    assert bpe_words.encode(spark.createDataFrame([], "doc_id long, text string"), PATH, PATTERN, round_trip=True).count() == 0
