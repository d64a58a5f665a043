"""Files of JSON lines and CSV with the place of every row, strict or with bad rows set aside.

Line numbers need no sort and no shuffle of lines: a split's lines are consecutive, so a line's number is its
distance from the split's first line plus the lines of the file's splits before, and of these there is one row
per split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types

from lorekiln.functions import text as T

#: Columns that a table of documents must have.
REQUIRED_COLUMNS = ("name", "description", "content")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (__file, __block, __id, ...) with ``line_number`` within each file, from 1."""
    splits = rows.groupBy("__file", "__block").agg(F.min("__id").alias("__first"), F.count("*").alias("__lines"))
    earlier = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("__before", F.coalesce(F.sum("__lines").over(earlier), F.lit(0))).drop("__lines")
    found = rows.join(splits, ["__file", "__block"])
    return found.withColumn("line_number", F.col("__before") + F.col("__id") - F.col("__first") + 1).drop("__block", "__id", "__first", "__before").withColumnRenamed("__file", "file")


def _placed(read: DataFrame, *columns: Column | str) -> DataFrame:
    return read.select(F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"), *columns)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, line), empty lines too."""
    return _numbered(_placed(spark.read.text(path), F.col("value").alias("line")))


@dataclass(frozen=True)
class Scan:
    """records: file, line_number, line (an object as JSON). invalid: file, line_number, reason, line."""

    records: DataFrame
    invalid: DataFrame


def scan_jsonl(spark: SparkSession, path: str) -> Scan:
    """Lines that are objects, and the others but for blank ones: ``invalid_json``, ``record_not_object``."""
    lines = numbered_lines(spark, path).withColumn("line", F.trim(F.regexp_replace("line", f"^{T.SPACES}|{T.SPACES}$", ""))).filter("line <> ''")
    value = F.try_parse_json("line")
    reason = F.when(value.isNull(), "invalid_json").when(~F.col("line").startswith("{"), "record_not_object")
    judged = lines.withColumn("reason", reason)
    return Scan(judged.filter("reason is null").drop("reason"), judged.filter("reason is not null").select("file", "line_number", "reason", "line"))


def _refuse(invalid: DataFrame, what: str) -> None:
    """Raises for the first of ``invalid``."""
    first = invalid.agg(F.min(F.struct("file", "line_number", "reason")).alias("f")).first()["f"]
    if first is not None:
        raise ValueError(f"{first['file']}:{first['line_number']}: {what}: {first['reason']}")


def read_jsonl_strict(spark: SparkSession, path: str, schema: types.StructType) -> DataFrame:
    """All records; the first line that is no object fails the read, with its file and number."""
    scan = scan_jsonl(spark, path)
    _refuse(scan.invalid, "bad line")
    return scan.records.select("file", "line_number", F.from_json("line", schema).alias("r")).select("file", "line_number", "r.*")


@dataclass(frozen=True)
class Mentions:
    """mentions: file, line_number, doc_id, entity_index, mention_id, entity (JSON). invalid: file,
    line_number, reason, line. skipped: file, line_number of records without entities."""

    mentions: DataFrame
    invalid: DataFrame
    skipped: DataFrame


def flatten_mentions(scan: Scan) -> Mentions:
    """A row per entity of each record. A record without an id or whose entities are no list, and an entity
    that is no object, are invalid; a record without entities is skipped."""
    record = F.try_parse_json("line")
    listed = F.try_variant_get(record, "$.entities", "array<variant>")
    rows = scan.records.select(
        "file", "line_number", "line", F.trim(F.coalesce(F.try_variant_get(record, "$.doc_id", "string"), F.lit(""))).alias("doc_id"),
        F.coalesce(F.try_variant_get(record, "$.entities", "string").isNull() & listed.isNull(), F.lit(True)).alias("none"), F.transform(listed, lambda e: F.to_json(e)).alias("entities"),
    )
    reason = F.when(F.col("doc_id") == "", "missing_doc_id").when(~F.col("none") & F.col("entities").isNull(), "entities_not_list")
    judged = rows.withColumn("reason", reason)
    sound = judged.filter("reason is null and not none").select("file", "line_number", "line", "doc_id", F.posexplode("entities").alias("entity_index", "entity"))
    number = F.concat(F.lit("m_"), T.padded(F.col("line_number"), 7), F.lit("_"), T.padded(F.col("entity_index"), 2))
    sound = sound.withColumn("mention_id", number)
    is_object = F.coalesce(F.col("entity").startswith("{"), F.lit(False))
    bad = sound.filter(~is_object).select("file", "line_number", F.lit("entity_not_object").alias("reason"), F.coalesce("entity", F.lit("null")).alias("line"))
    invalid = scan.invalid.unionByName(judged.filter("reason is not null").select("file", "line_number", "reason", "line")).unionByName(bad)
    skipped = judged.filter("reason is null and none").select("file", "line_number")
    return Mentions(sound.filter(is_object).drop("line"), invalid, skipped)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, doc_id, columns) of CSV documents, quoted fields of any length and lines, a byte
    order mark or none. ``line_number`` counts rows; an id is made of it and of the content's hash. Fails if a
    required column is missing."""
    read = spark.read.options(header=True, multiLine=True, escape='"', maxCharsPerColumn=-1).csv(path)
    names = [c.lstrip("﻿") for c in read.columns]
    missing = sorted(set(REQUIRED_COLUMNS) - set(names))
    if missing:
        raise ValueError(f"CSV is missing required columns: {', '.join(missing)}")
    rows = _numbered(_placed(read, *[F.col(f"`{old}`").alias(new) for old, new in zip(read.columns, names, strict=True)]))
    content = T.text_or_empty(F.col("content"))
    made = F.concat(F.lit("doc_"), T.padded(F.col("line_number"), 6), F.lit("_"), F.left(F.sha2(content, 256), F.lit(8)))
    return rows.select("file", "line_number", made.alias("doc_id"), *names)
