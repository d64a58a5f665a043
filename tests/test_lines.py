from __future__ import annotations

import csv
import json

import pytest
from pyspark.sql import types

from lorekiln.sources import lines


def test_line_numbers_of_files_in_many_splits(spark, tmp_path):
    wanted = {}
    for name, n in (("a", 900), ("b", 3), ("c", 0)):
        rows = ["" if k % 7 == 3 else f"{name}{k} " + "x" * (k % 50) for k in range(n)]
        (tmp_path / f"{name}.txt").write_bytes(("\r\n" if name == "b" else "\n").join(rows).encode() + (b"\n" if rows else b""))
        wanted |= {(name, k + 1): row for k, row in enumerate(rows)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        found = lines.numbered_lines(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() >= 1
        got = {(r.file.rpartition("/")[2][0], r.line_number): r.line for r in found.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == wanted


ROWS = [
    {"doc_id": "d1", "entities": [{"surface": "a"}, 5, {"surface": "b"}, None]}, "", "{broken", [1], 7, {"doc_id": "", "entities": []}, {"entities": [{}]}, {"doc_id": "d2"},
    {"doc_id": "d3", "entities": None}, {"doc_id": "d4", "entities": "x"}, {"doc_id": "d5", "entities": {}}, {"doc_id": "d6", "entities": []}, {"doc_id": 7, "entities": [{"q": [1]}]},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("lines") / "records.jsonl"
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in ROWS) + "\n")
    return str(path)


def test_bad_lines_are_set_aside(spark, folder):
    scan = lines.scan_jsonl(spark, folder)
    assert sorted((r.line_number, r.reason) for r in scan.invalid.collect()) == [(3, "invalid_json"), (4, "record_not_object"), (5, "record_not_object")]
    assert sorted(r.line_number for r in scan.records.collect()) == [1, 6, 7, 8, 9, 10, 11, 12, 13]


def test_mentions(spark, folder):
    found = lines.flatten_mentions(lines.scan_jsonl(spark, folder))
    got = sorted((r.mention_id, r.doc_id, json.loads(r.entity)) for r in found.mentions.collect())
    assert got == [("m_0000001_00", "d1", {"surface": "a"}), ("m_0000001_02", "d1", {"surface": "b"}), ("m_0000013_00", "7", {"q": [1]})]
    assert sorted((r.line_number, r.reason) for r in found.invalid.collect()) == [
        (1, "entity_not_object"), (1, "entity_not_object"), (3, "invalid_json"), (4, "record_not_object"), (5, "record_not_object"),
        (6, "missing_doc_id"), (7, "missing_doc_id"), (10, "entities_not_list"), (11, "entities_not_list"),
    ]
    assert sorted(r.line_number for r in found.skipped.collect()) == [8, 9]


def test_strict_reading_names_the_first_bad_line(spark, folder, tmp_path):
    schema = types.StructType().add("doc_id", "string")
    with pytest.raises(ValueError, match=r"records\.jsonl:3: bad line: invalid_json"):
        lines.read_jsonl_strict(spark, folder, schema)
    good = tmp_path / "good.jsonl"
    good.write_text('{"doc_id": "a"}\n\n{"doc_id": "b", "more": 1}\n')
    assert sorted((r.line_number, r.doc_id) for r in lines.read_jsonl_strict(spark, str(good), schema).collect()) == [(1, "a"), (3, "b")]


def test_csv_documents(spark, tmp_path):
    path = tmp_path / "documents.csv"
    with path.open("w", encoding="utf-8-sig", newline="") as out:
        rows = csv.writer(out)
        rows.writerow(["name", "description", "content", "extra"])
        rows.writerows([["n1", "", 'line one\nline "two"', "x"], ["n2", "d", "y" * 200_000, ""]])
    found = sorted(lines.read_documents(spark, str(path)).collect(), key=lambda r: r.line_number)
    assert [(r.line_number, r.name, r.content, r.extra) for r in found] == [(1, "n1", 'line one\nline "two"', "x"), (2, "n2", "y" * 200_000, None)]
    assert [r.doc_id[:11] for r in found] == ["doc_000001_", "doc_000002_"]
    (tmp_path / "bad.csv").write_text("name,content\na,b\n")
    with pytest.raises(ValueError, match="missing required columns: description"):
        lines.read_documents(spark, str(tmp_path / "bad.csv"))
