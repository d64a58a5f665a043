"""Exact deduplication: 128-bit content hash, smallest stable id, byte comparison.

Defined results
    null text counts as empty; texts that differ only in runs of ASCII white space are equal.
    null ids come last: a row without an id stays only if no copy has one.
    repeated rows (same id, same text): one of them stays.
    an empty table gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace

#: A run of white space, unless it is a single space already.
LOOSE_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty, each run of ``[\\x20\\x09-\\x0D]`` as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), LOOSE_SPACE, " ")


def content_hash(text: Column) -> Column:
    """128 bits, as hex."""
    return F.md5(text)


def _keyed(docs: DataFrame, id_col: str, text_col: str, hash128: Callable[[Column], Column]) -> DataFrame:
    norm = normalised(F.col(text_col))
    return docs.select(F.col(id_col).alias("id"), hash128(norm).alias("key"), norm.alias("norm"))


def _collided(keyed: DataFrame) -> DataFrame:
    """Keys that stand for several texts. Grouping by key and text compares the bytes of
    all members of a hash group, copies fold before the shuffle."""
    texts = keyed.groupBy("key", "norm").agg(F.count("*").alias("rows"))
    return texts.groupBy("key").agg(F.count("*").alias("texts")).filter("texts > 1").select("key")


def group_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash128: Callable[[Column], Column] = content_hash,
) -> tuple[DataFrame, DataFrame]:
    """(members, collided keys): a row per row of ``docs`` with its group.

    members: id, key, text_sha256, keep_id, group_size, kept. Groups are found on narrow
    rows; whole texts move only to be compared. Where the comparison finds a key with
    several texts, the text itself replaces that key.
    """
    work = Workspace(docs.sparkSession, "exact-dedup")
    keyed = _keyed(docs, id_col, text_col, hash128)
    collided = work.keep(_collided(keyed), "collided")
    if not collided.isEmpty():
        marked = collided.withColumn("collides", F.lit(True))
        keyed = keyed.join(marked, "key", "left").select(
            "id", F.when(F.col("collides"), F.concat(F.lit("text:"), "norm")).otherwise(F.col("key")).alias("key"), "norm"
        )
    rows = work.keep(
        keyed.select("id", "key", F.sha2("norm", 256).alias("text_sha256"), F.monotonically_increasing_id().alias("row")),
        "rows",
    )
    first = F.min(F.struct(F.isnull("id").alias("no_id"), "id", "row"))
    groups = work.keep(
        rows.groupBy("key")
        .agg(first.alias("first"), F.count("*").alias("group_size"))
        .select("key", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size"),
        "groups",
    )
    # Both sides are plain tables, so a hot key's partition can be split at run time.
    members = rows.join(groups, "key").select(
        "id", "key", "text_sha256", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )
    return members, collided


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash128: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """A row per document: id, keep_id, group_size, kept, text_sha256."""
    members, _ = group_rows(docs, id_col, text_col, hash128)
    return members.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    members, _ = group_rows(docs, id_col, text_col)
    kept = members.filter("kept").select(F.col("id").alias("__id"), F.col("text_sha256").alias("__sha"))
    work = Workspace(docs.sparkSession, "drop-copies")
    kept = work.keep(kept, "kept")
    keyed = docs.withColumn("__text", F.sha2(normalised(F.col(text_col)), 256))
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__sha"))
    staying = keyed.join(kept, same, "left_semi")
    repeated = members.filter(F.col("id").eqNullSafe(F.col("keep_id"))).groupBy("id", "key").count().filter("count > 1")
    if not repeated.isEmpty():
        staying = staying.dropDuplicates([id_col, "__text"])
    return staying.drop("__text")
