"""Record checks, group verdicts and batch filling over many tasks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.operators import blocks, external, links, windows


def plain_fill(rows, most_rows, most_size, alone):
    out, last, batch, n, total = [], object(), 0, 0, 0
    for group, order, size in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        size = size or 0
        if group != last:
            last, batch, n, total = group, 0, 0, 0
        if n and (n >= most_rows or total + size > most_size or size > alone):
            batch, n, total = batch + 1, 0, 0
        n, total = n + 1, total + size
        out.append((group, order, batch))
        if size > alone:
            n = most_rows
    return out


@pytest.mark.parametrize("partitions", [1, 13, 60])
@pytest.mark.parametrize("most_rows, most_size, alone", [(5, 60, float("inf")), (2, 40, 20), (9, 1000, float("inf")), (1, 10, 5)])
def test_bin_fill_over_many_tasks(spark, partitions, most_rows, most_size, alone):
    rng = random.Random(partitions * most_rows)
    rows = [("hot", k, rng.randint(0, 30)) for k in range(400)] + [(f"g{k % 40}", k, rng.randint(0, 30)) for k in range(120)]
    rows += [(None, k, rng.choice([None, 7])) for k in range(30)] + [("z", k, 3) for k in range(100)]
    rng.shuffle(rows)
    settings = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = spark.createDataFrame(rows, "g string, o long, n int")
        found = windows.bin_fill(df, "g", "o", "n", most_rows, most_size, alone).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, found), key=repr) == sorted(plain_fill(rows, most_rows, most_size, alone), key=repr)


def test_bin_fill_of_nothing(spark):
    assert windows.bin_fill(spark.createDataFrame([], "g string, o long, n int"), "g", "o", "n", 5, 60).count() == 0


def test_flat_records(spark):
    raw = ["{", '{"entities": []}', '{"doc_id": "a"}', '{"doc_id": "b", "entities": 5}', '{"doc_id": "c", "entities": [{"s": 1}, 7, null]}', None]
    df = spark.createDataFrame(list(enumerate(raw)), "id int, raw string")
    found = {(r.id, r.doc_id, r.entity_index, r.invalid) for r in blocks.flat_records(df, "id", "raw").collect()}
    assert found == {
        (0, None, None, "invalid_json"), (1, None, None, "missing_doc_id"), (3, "b", None, "entities_not_a_list"),
        (4, "c", 0, None), (4, "c", 1, "entity_not_an_object"), (4, "c", 2, "entity_not_an_object"), (5, None, None, "invalid_json"),
    }


def test_block_issues(spark):
    docs = spark.createDataFrame([(1, "Head\n\n- \n- item\n12 34\nA sentence.")], "doc_id long, text string")
    found = {(r.block_index, r.issue) for r in blocks.block_issues(blocks.line_blocks(docs)).collect()}
    assert (1, "empty_block") in found and (4, "header_without_letters") in found and (0 not in {k for k, _ in found})


def test_label_functions(spark):
    df = spark.createDataFrame([("аспирин 20 мг таблетки №20 форте",), ("ab 5 мг",), ("name type II",), ("type",), ("",)], "t string")
    rows = df.select(T.product_name(F.col("t")).alias("p"), T.subtype(F.col("t")).alias("s")).collect()
    assert [tuple(r.p) for r in rows[:2]] == [("аспирин форте", True, False), ("ab 5 мг", False, True)]
    assert [r.s for r in rows] == ["none", "none", "type_ii", "type_marker", "none"]


def test_quotes_and_titles(spark):
    df = spark.createDataFrame([([],), (None,), (["exact"],), (["exact", "normalized_exact"],), (["exact", "not_found"],), (["fuzzy"],)], "s array<string>")
    assert [r[0] for r in df.select(S.rolled_up(F.col("s"))).collect()] == ["not_found", "not_found", "exact", "normalized_exact", "partly_found", "fuzzy"]
    pairs = spark.createDataFrame([("Long title", "A long title, really"), ("abcdefgh", "abcdefgx"), ("abc", "xyz"), ("", "x"), (None, None)], "a string, b string")
    assert [r[0] for r in pairs.select(S.title_close(F.col("a"), F.col("b"))).collect()][:4] == [True, True, False, False]


def test_object_of_and_sole_candidates(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```',), ("[1]",), ("{",)], "r string")
    assert [r[0] for r in df.select(external.object_of(F.col("r"))[1]).collect()] == ["ok", "not_an_object", "not_json"]
    tags = spark.createDataFrame([(1, "a", True), (1, "b", False), (2, "a", True), (2, "b", True), (2, "b", True)], "d int, t string, c boolean")
    assert {tuple(r) for r in links.sole_candidates(tags, "d", "t", "c").collect()} == {(1, "a", True), (2, "a", False), (2, "b", False)}
