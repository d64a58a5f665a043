from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types

from lorekiln.operators import blocks, evidence, external, links, pairs, windows
from lorekiln.operators.graph import connected_components
from lorekiln.sources import files
from lorekiln.sources.shared import Workspace
from lorekiln.streaming import upsert


def test_connected_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(7, 7), (None, 1)]
    parent: dict[int, int] = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    found = connected_components(spark.createDataFrame(edges, "src long, dst long"), Workspace(spark, "t"))
    assert {r.node: r.component for r in found.collect()} == {k: root(k) for k in parent}


def test_connected_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long"), Workspace(spark, "t")).count() == 0


def test_blocked_pairs_skip_large_buckets(spark):
    nodes = spark.createDataFrame([(k, "t", "big", f"s{k // 2}") for k in range(6)] + [(9, "u", "big", None)], "id long, type string, a string, b string")
    keys = {"a": F.col("a"), "b": F.col("b")}
    found = pairs.blocked_pairs(nodes, "id", "type", keys, {"a": 5, "b": 5}).collect()
    assert {(r.left_id, r.right_id, r.reasons) for r in found} == {(0, 1, "b"), (2, 3, "b"), (4, 5, "b")}
    assert [(r.bucket, r.n) for r in pairs.skipped_buckets(nodes, "id", "type", keys, {"a": 5, "b": 5}).collect()] == [("a", 6)]


def test_clique_groups_stay_complete(spark):
    rows = [("t", 1, 1, 2, 0.9), ("t", 1, 2, 3, 0.8), ("t", 1, 1, 3, 0.7), ("t", 1, 3, 4, 0.6)]
    df = spark.createDataFrame(rows, "type string, component long, left_id long, right_id long, score double")
    found = sorted(r.nodes for r in pairs.clique_groups(df, "type", "score").collect())
    assert found == ["1,2", "1,3", "2,3", "3,4"] or found[0].startswith("1,2")


def test_quote_hits_of_any_length(spark):
    quotes = spark.createDataFrame([(1, "one"), (2, "One two, three four five"), (3, ""), (4, None), (5, "wo three")], "q long, quote string")
    docs = spark.createDataFrame([(1, "zero one two three four five six"), (2, "one"), (3, ""), (4, None)], "d long, text string")
    found = links.quote_hits(quotes, "q", "quote", docs, "d", "text").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (1, 2), (2, 1)]


def test_merged_islands(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 4, 5), ("a", 9, 9), ("a", 2, 8), ("b", 1, 1), ("b", 3, 4)], "k string, b long, e long")
    found = windows.merged_islands(df, ["k"], "b", "e").collect()
    assert sorted(map(tuple, found)) == [("a", 1, 9, 4), ("b", 1, 1, 1), ("b", 3, 4, 1)]


def test_bin_fill_and_trim(spark):
    df = spark.createDataFrame([("g", k, n) for k, n in enumerate([5, 5, 20, 1, 1, 1, 1])], "g string, o long, n long")
    found = windows.bin_fill(df, "g", "o", "n", 3, 12).collect()
    assert [r.batch for r in sorted(found, key=lambda r: r.o)] == [0, 0, 1, 2, 2, 2, 3]
    kept = windows.trim_to_budget(df.withColumn("c", F.lit(2)), ["g"], "o", "c", "n", 3).collect()
    assert [r.o for r in kept] == [2]


def test_model_calls_survive_failures_and_bad_answers(spark):
    answers = {"a": '```json\n{"entities": [{"surface": "A", "role": "r", "confidence": 0.5}]}\n```', "b": "no json", "d": '{"entities": [{"surface": " ", "role": "r", "confidence": 2}]}'}

    def model(request: str) -> str:
        return answers[request]

    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), (None,)], "q string")
    found = {r.q: r for r in external.entities(external.call(df, "q", model), "response").collect()}
    assert found["a"].entities[0].surface == "A" and found["a"].errors == []
    assert found["b"].errors == found["c"].errors == found[None].errors == ["invalid_response"]
    assert found["d"].errors == ["confidence_out_of_range", "empty_surface"]


def test_files_round_trip(spark, tmp_path):
    schema = types.StructType([types.StructField("a", types.LongType()), types.StructField("b", types.StringType())])
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "x"}\nnot json\n[1]\n\n{"a": 2}\n')
    good, bad = files.read_jsonl_permissive(spark, str(tmp_path / "x.jsonl"), schema)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (2, None)]
    assert sorted(r.reason for r in bad.collect()) == ["invalid_json", "record_not_object"]
    assert files.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    (tmp_path / "d.csv").write_text('﻿name,description,content\n"n","two\nlines","{""a"": 1}"\n', encoding="utf-8")
    row = files.read_documents_csv(spark, str(tmp_path / "d.csv")).first()
    assert (row["description"], row["content"]) == ("two\nlines", '{"a": 1}')
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, tags array<string>")
    files.write_csv(df, str(tmp_path / "out"))
    assert files.read_csv(spark, str(tmp_path / "out")).first()["tags"] == '["a","b"]'


def test_streaming_upsert(spark, tmp_path):
    source, table = tmp_path / "in", tmp_path / "table"
    for k, rows in enumerate([[("a", 1, "old"), ("b", 1, "only")], [("a", 2, "new")]]):
        spark.createDataFrame(rows, "key string, at long, value string").write.mode("append").json(str(source))
        stream = spark.readStream.schema("key string, at long, value string").json(str(source))
        upsert.append_batches(stream, str(table), str(tmp_path / "checkpoint")).awaitTermination(60)
    found = upsert.active_rows(spark, str(table), ["key"], "at").collect()
    assert sorted((r.key, r.value) for r in found) == [("a", "new"), ("b", "only")]
