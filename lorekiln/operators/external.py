"""Calls of an external model: requests, responses, validation and resume.

The model is a function from request texts to response texts; the stub below answers the same
for the same request, so that everything around it can be run and tested.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENTITY = "array<struct<surface: string, role: string, confidence: double>>"
MOST_ENTITIES = 20


def stub_model(request: str) -> str:
    """The first capitalised words of the request's text as entities."""
    words = [w.strip(".,;:!?") for w in json.loads(request)["text"].split()]
    found = list(dict.fromkeys(w for w in words if w[:1].isupper() and len(w) > 2))[:5]
    return json.dumps({"entities": [{"surface": w, "role": "article_candidate" if len(w) > 5 else "context_only", "confidence": round(min(1.0, len(w) / 10), 2)} for w in found]})


def request_of(text: Column, prompt_version: str) -> Column:
    return F.to_json(F.struct(F.lit(prompt_version).alias("prompt_version"), text.alias("text")))


def cache_key(request: Column) -> Column:
    return F.sha2(request, 256)


def call(requests: DataFrame, request_col: str, model: Callable[[str], str], out: str = "response") -> DataFrame:
    """``requests`` with the model's responses; a failing call leaves null."""

    @F.arrow_udf("string")
    def ask(texts: pa.Array) -> pa.Array:
        answers = []
        for text in texts.to_pylist():
            try:
                answers.append(None if text is None else model(text))
            except Exception:  # the model is foreign code: its failure is a missing response
                answers.append(None)
        return pa.array(answers, pa.string())

    return requests.withColumn(out, ask(F.col(request_col)))


def resumed(requests: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Requests without a stored response."""
    return requests.join(done.select(key).distinct(), key, "left_anti")


def entities(responses: DataFrame, response_col: str) -> DataFrame:
    """``responses`` with parsed ``entities`` and ``errors``; code fences are taken off."""
    bare = F.regexp_replace(F.col(response_col), r"^\s*```[a-z]*\s*|\s*```\s*$", "")
    parsed = F.from_json(bare, f"struct<entities: {ENTITY}>")["entities"]
    score = F.exists("entities", lambda e: e["confidence"].isNull() | (e["confidence"] < 0) | (e["confidence"] > 1))
    out = responses.withColumn("entities", parsed)
    rules = [
        F.when(F.col("entities").isNull(), "invalid_response"),
        F.when(F.size("entities") > MOST_ENTITIES, "too_many_entities"),
        F.when(score, "confidence_out_of_range"),
        F.when(F.exists("entities", lambda e: F.trim(e["surface"]) == ""), "empty_surface"),
    ]
    return out.withColumn("errors", F.filter(F.array(*rules), lambda e: e.isNotNull()))


def cost(tokens: Column, price_per_million: float) -> Column:
    return F.round(tokens * price_per_million / 1_000_000, 8)


def halved(tasks: DataFrame, batch: str, order: list[str], failed: str) -> DataFrame:
    """``batch_id``: batches with a failed task are split in two, with suffixes s1 and s2."""
    whole = Window.partitionBy(batch)
    place = F.row_number().over(whole.orderBy(*order))
    marked = tasks.withColumn("place", place).withColumn("__n", F.count("*").over(whole)).withColumn("__failed", F.bool_or(failed).over(whole))
    half = F.when(F.col("place") <= F.floor((F.col("__n") + 1) / 2), "_s1").otherwise("_s2")
    name = F.when(F.col("__failed") & (F.col("__n") > 1), F.concat(F.col(batch).cast("string"), half)).otherwise(F.col(batch).cast("string"))
    return marked.withColumn("batch_id", name).drop("__n", "__failed")


def object_of(response: Column) -> tuple[Column, Column]:
    """(text, status) of a response without its code fence: ok, not_json or not_an_object."""
    bare = F.trim(F.regexp_replace(response, r"^\s*```[a-z]*\s*|\s*```\s*$", ""))
    parsed = F.try_parse_json(bare)
    status = F.when(parsed.isNull(), "not_json").when(~F.schema_of_variant(parsed).startswith("OBJECT"), "not_an_object").otherwise("ok")
    return bare, status
