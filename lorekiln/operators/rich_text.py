"""Documents of typed blocks in JSON, as text.

Spark has no expression for blocks that nest without a bound, so one Arrow function reads a document; what
follows, rows per block, counts and checks, are DataFrames.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions.batches import by_slices, small_batches

#: Keys that blocks of unknown types are searched for, in this order.
TEXT_KEYS = (
    "text",
    "caption",
    "title",
    "message",
    "items",
    "content",
    "data",
    "description",
)
#: Types whose texts are these fields, one below the other; types that may be empty;
#: types of plain text, where the first field that is filled counts; fields that are kept beside the text.
FIELDS = {"paragraph": ["text"], "header": ["text"], "quote": ["text", "caption"], "warning": ["title", "message"], "delimiter": []} | dict.fromkeys(
    ("image", "embed"), ["caption", "title", "description"]
)
MAY_BE_EMPTY = ("delimiter", "image", "embed")
PLAIN = {"code": ("code", "text"), "raw": ("html", "text")}
KEPT = {"header": ("level",), "list": ("style",), "image": ("service", "source"), "embed": ("service", "source")}
LABELS = ("content", "text", "title", "message")

PARSED = (
    "struct<parse_status: string, parse_errors: array<string>, clean_text: string, blocks: array<struct<block_index: int, block_id: string, block_type: string,"
    " text: string, text_length: int, metadata: string, raw_block_hash: string, parse_status: string>>>"
)


def plain_text(value: Any) -> str:
    """Entities resolved, runs of blanks as one, at most one empty line in a row."""
    text = re.sub(r"[ \t\r\f\v]+", " ", html.unescape("" if value is None else str(value)))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def marked_text(value: Any) -> str:
    """:func:`plain_text` without tags."""
    return plain_text(None if value is None else re.sub(r"<[^>]+>", " ", str(value)))


def texts_below(value: Any) -> Iterator[str]:
    """All texts in lists and under :data:`TEXT_KEYS`, depth first."""
    if isinstance(value, dict):
        value = [value[key] for key in TEXT_KEYS if key in value]
    if isinstance(value, list):
        for one in value:
            yield from texts_below(one)
    elif text := marked_text(value):
        yield text


def _once(value: Any) -> list[str]:
    return list(dict.fromkeys(texts_below(value)))


def _filled(fields: dict, names: tuple[str, ...]) -> Any:
    return next((fields[n] for n in names if fields.get(n)), None)


def _bullets(items: Any, depth: int = 0) -> Iterator[str]:
    if not isinstance(items, list):
        yield from _once(items)
        return
    for item in items:
        inner = item.get("items") if isinstance(item, dict) else None
        if text := marked_text(_filled(item, LABELS) if isinstance(item, dict) else item):
            yield f"{'  ' * depth}- {text}"
        if isinstance(inner, list):
            yield from _bullets(inner, depth + 1)
        elif isinstance(item, dict) and not text:
            yield from _once(item)


def _rows(content: Any) -> Iterator[str]:
    for row in content if isinstance(content, list) else _once(content):
        yield "\t".join(filter(None, map(marked_text, row))) if isinstance(row, list) else marked_text(row)


def _ticks(items: Any) -> Iterator[str]:
    if not isinstance(items, list):
        yield from _once(items)
        return
    for item in items:
        box, label = ("[x]" if item.get("checked") else "[ ]", _filled(item, ("text", "content"))) if isinstance(item, dict) else ("[ ]", item)
        if text := marked_text(label):
            yield f"{box} {text}"


def block_text(kind: str, data: dict) -> str:
    if kind in FIELDS:
        lines = [marked_text(data.get(name)) for name in FIELDS[kind]]
    elif kind in PLAIN:
        lines = [plain_text(_filled(data, PLAIN[kind]))]
    elif kind in ("list", "checklist"):
        lines = list((_bullets if kind == "list" else _ticks)(data.get("items")))
    else:
        lines = list(_rows(data.get("content"))) if kind == "table" else _once(data)
    return "\n".join(filter(None, lines)).strip()


def _block(raw: Any, index: int) -> dict:
    own = raw if isinstance(raw, dict) else {}
    kind, data = str(own.get("type") or "unknown"), own.get("data") if isinstance(own.get("data"), dict) else {}
    kept = {name: data[name] for name in KEPT.get(kind, ()) if name in data} | ({"source_block_id": str(own["id"])} if own.get("id") else {})
    text = block_text(kind, data)
    canonical = json.dumps(raw, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    return {
        "block_index": index, "block_id": f"b_{index + 1:06d}", "block_type": kind, "text": text, "text_length": len(text), "metadata": json.dumps(kept, ensure_ascii=False),
        "raw_block_hash": hashlib.sha256(canonical.encode("utf-8", "surrogatepass")).hexdigest(), "parse_status": "ok" if text or kind in MAY_BE_EMPTY else "empty_or_unhandled_block",
    }


def _root(raw: str) -> tuple[Any, list[str]]:
    """The value, which may be JSON inside a JSON text twice, and what is wrong with it."""
    try:
        value = json.loads(raw)
    except json.JSONDecodeError as e:
        return None, [f"invalid_json:{e.msg}"]
    for _ in range(2):
        if not (isinstance(value, str) and value.strip()[:1] in ("{", "[")):
            break
        try:
            value = json.loads(value)
        except json.JSONDecodeError as e:
            return value, [f"nested_json_string_invalid:{e.msg}"]
    return value, []


def _found_blocks(value: Any) -> tuple[list, str | None]:
    if isinstance(value, list):
        return value, "editorjs_root_is_blocks_list"
    if not isinstance(value, dict):
        return [], f"editorjs_unexpected_root_type:{type(value).__name__}"
    if isinstance(value.get("blocks"), list):
        return value["blocks"], None
    if value.get("type") or value.get("data"):
        return [value], "editorjs_container_missing_blocks_treated_as_single_block"
    return [], "editorjs_container_missing_blocks"


def parse(raw: str | None) -> dict:
    """Status, errors, text and blocks of one document."""

    def result(status: str, errors: list[str], text: str = "", blocks: list[dict] = []) -> dict:  # noqa: B006
        return {"parse_status": status, "parse_errors": errors, "clean_text": text, "blocks": blocks}

    if raw is None or not raw.strip():
        return result("empty", ["empty_content"])
    value, errors = _root(raw)
    if value is None:
        return result("failed", errors)
    found, fault = _found_blocks(value)
    errors += [fault] if fault else []
    if not found:
        text = "\n".join(_once(value))
        if not text:
            return result("partial" if errors else "empty", errors or ["editorjs_blocks_empty"])
        found, errors = [{"type": "unknown_document", "data": {"text": text}}], [*errors, "editorjs_blocks_missing_used_recursive_text"]
    blocks = [_block(block, k) for k, block in enumerate(found)]
    errors += [f"block_{b['block_id']}_empty_or_unhandled:{b['block_type']}" for b in blocks if b["parse_status"] != "ok"]
    text = "\n\n".join(b["text"] for b in blocks if b["text"]).strip()
    return result("empty" if not text else "partial" if errors else "ok", errors, text, blocks)


_STRINGS = [(n, pa.string()) for n in ("block_id", "block_type", "text")]
_BLOCK = pa.struct([("block_index", pa.int32()), *_STRINGS, ("text_length", pa.int32()), *[(n, pa.string()) for n in ("metadata", "raw_block_hash", "parse_status")]])
_DOCUMENT = pa.struct([("parse_status", pa.string()), ("parse_errors", pa.list_(pa.string())), ("clean_text", pa.string()), ("blocks", pa.list_(_BLOCK))])


def parsed(content: Column) -> Column:
    """Struct of :data:`PARSED`."""

    @F.arrow_udf(PARSED)
    def of(texts: pa.Array) -> pa.Array:
        return by_slices(texts, lambda some: list(map(parse, some)), _DOCUMENT)

    return of(content)


def block_rows(docs: DataFrame, id_col: str, content: str) -> DataFrame:
    """A row per block, with the id of its document."""
    small_batches(docs.sparkSession)
    return docs.select(id_col, F.explode(parsed(F.col(content)).getField("blocks")).alias("b")).select(id_col, "b.*")
