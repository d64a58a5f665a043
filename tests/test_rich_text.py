from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lorekiln.operators import rich_text


def blocks(*some):
    return json.dumps({"blocks": [{"type": kind, "data": data} for kind, data in some]}, ensure_ascii=False)


CASES = [
    (blocks(("header", {"text": "A", "level": 2}), ("paragraph", {"text": "<b>b</b> &amp; c"})), "ok", [], ["A", "b & c"]),
    ("{broken", "failed", ["invalid_json:Expecting property name enclosed in double quotes"], []),
    ("", "empty", ["empty_content"], []),
    (None, "empty", ["empty_content"], []),
    ("null", "failed", [], []),
    ("7", "partial", ["editorjs_unexpected_root_type:int", "editorjs_blocks_missing_used_recursive_text"], ["7"]),
    ("{}", "partial", ["editorjs_container_missing_blocks"], []),
    ('{"blocks": []}', "empty", ["editorjs_blocks_empty"], []),
    ('{"title": "t", "other": "no", "text": "u"}', "partial", ["editorjs_container_missing_blocks", "editorjs_blocks_missing_used_recursive_text"], ["u\nt"]),
    ('{"type": "paragraph", "data": {"text": "x"}}', "partial", ["editorjs_container_missing_blocks_treated_as_single_block"], ["x"]),
    (json.dumps([{"type": "paragraph", "data": {"text": "x"}}]), "partial", ["editorjs_root_is_blocks_list"], ["x"]),
    (json.dumps(blocks(("list", {"items": ["a", {"content": "b", "items": ["c", {"text": "d", "items": ["e"]}]}]}))), "ok", [], ["- a\n- b\n  - c\n  - d\n    - e"]),
    (json.dumps("{broken"), "partial", ["nested_json_string_invalid:Expecting property name enclosed in double quotes", "editorjs_unexpected_root_type:str",
                                       "editorjs_blocks_missing_used_recursive_text"], ["{broken"]),
    (blocks(("table", {"content": [["a", " b "], ["", ""], "c"]}), ("delimiter", {}), ("image", {})), "ok", [], ["a\tb\nc", "", ""]),
    (blocks(("own", {"title": "t", "items": [{"text": "u"}, {"text": "t"}], "message": 5})), "ok", [], ["t\n5\nu"]),
    (blocks(("checklist", {"items": [{"text": "p", "checked": True}, {"content": "q"}, "r", {"text": " "}]})), "ok", [], ["[x] p\n[ ] q\n[ ] r"]),
    (blocks(("code", {"code": "", "text": "a <b>  c"}), ("raw", {"html": "<p>&lt;</p>"})), "ok", [], ["a <b> c", "<p><</p>"]),
    (blocks(("quote", {"text": "q", "caption": "c"}), ("warning", {"message": "m"}), ("embed", {"caption": "x", "description": "z"})), "ok", [], ["q\nc", "m", "x\nz"]),
    (blocks(("paragraph", {"text": " "}), ("paragraph", {"text": "x"})), "partial", ["block_b_000001_empty_or_unhandled:paragraph"], ["", "x"]),
    (blocks(("list", {"items": {"text": "not a list"}}), ("list", {"items": [{"items": "x"}, {"title": "t"}]})), "ok", [], ["not a list", "x\n- t"]),
    ('{"blocks": ["text", null]}', "empty", ["block_b_000001_empty_or_unhandled:unknown", "block_b_000002_empty_or_unhandled:unknown"], ["", ""]),
]


@pytest.mark.parametrize(("raw", "status", "errors", "texts"), CASES)
def test_rules(raw, status, errors, texts):
    found = rich_text.parse(raw)
    assert (found["parse_status"], found["parse_errors"], [b["text"] for b in found["blocks"]]) == (status, errors, texts)
    assert found["clean_text"] == "\n\n".join(t for t in texts if t)


def test_keys_decide_the_order_of_texts():
    data = {key: key for key in reversed(rich_text.TEXT_KEYS)}
    assert rich_text.block_text("own", data) == "text\ncaption\ntitle\nmessage\nitems\ncontent\ndata\ndescription"


def test_blocks_keep_their_source_and_hash(spark):
    block = {"id": "src", "type": "header", "data": {"text": "Гастрит", "level": 2}}
    long = {"type": "paragraph", "data": {"text": "x" * 150_000}}
    df = spark.createDataFrame([(1, json.dumps({"blocks": [block, long]})), (2, None), (3, "[]")], "doc_id long, content string")
    first, second = rich_text.block_rows(df, "doc_id", "content").orderBy("block_index").collect()
    assert json.loads(first.metadata) == {"level": 2, "source_block_id": "src"}
    assert first.raw_block_hash == hashlib.sha256('{"data":{"level":2,"text":"Гастрит"},"id":"src","type":"header"}'.encode()).hexdigest()
    assert (first.block_id, first.text_length, second.text, second.text_length) == ("b_000001", 7, "x" * 150_000, 150_000)
    status = df.select("doc_id", rich_text.parsed(F.col("content")).getField("parse_status"))
    assert dict(map(tuple, status.collect())) == {1: "ok", 2: "empty", 3: "partial"}
