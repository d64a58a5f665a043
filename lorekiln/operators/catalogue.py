"""The catalogue of tags and their aliases: ids, one row per alias key, conflicts.

Aliases of a tag come from several sources; of those with one key, that of the best source stays, then the
shortest, then the first. Ids are hashes of what a row stands for; should two different things have one hash,
they are told apart by a number in order of what they stand for, so that ids do not depend on a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators.quotes import small
from lorekiln.sources.shared import Workspace

#: Sources of aliases, the best first.
SOURCES = (
    "n3_canonical",
    "n1_canonical_candidate_ru",
    "n1_surface",
    "n1_auto_cluster_alias",
    "n3_label",
    "n1_canonical_candidate_latin",
    "n4_generated",
)
DIGITS, TAG_DIGITS = 16, 10


def hashed_ids(rows: DataFrame, payload: Column, prefix: Column, digits: int, out: str) -> DataFrame:
    """``rows`` with an id of ``digits`` hexadecimal digits of the payload's hash. Of different payloads
    with one id, all but the first get ``_2``, ``_3``, ... behind it; equal payloads have equal ids. Only
    ids that collide are numbered, by an aggregate per id."""
    work = Workspace(rows.sparkSession, "hashed-ids")
    short = F.concat(prefix, F.left(F.sha2(F.col("__payload"), 256), F.lit(digits)))
    named = rows.withColumn("__payload", payload).withColumn(out, short)
    known = named.groupBy(out).agg(F.min("__payload").alias("__least"), F.max("__payload").alias("__most")).filter("__least <> __most")
    collided = work.keep(named.join(work.keep(known.select(out), "collided"), out, "left_semi").select(out, "__payload").distinct(), "payloads")
    if collided.isEmpty():
        return named.drop("__payload")
    listed = collided.groupBy(out).agg(F.array_sort(F.collect_set("__payload")).alias("__all"))
    numbers = listed.select(F.col(out).alias("__id"), F.posexplode("__all").alias("__n", "__of"))
    found = named.join(small(work.keep(numbers, "numbers")), (F.col(out) == F.col("__id")) & (F.col("__payload") == F.col("__of")), "left")
    marked = F.when(F.col("__n") > 0, F.concat_ws("_", out, (F.col("__n") + 1).cast("string"))).otherwise(F.col(out))
    return found.withColumn(out, marked).drop("__payload", "__id", "__n", "__of")


def tag_ids(tags: DataFrame, entity_type: str, names: list[str], alias_norms: str, out: str = "tag_id") -> DataFrame:
    """``tags`` with an id made of the type, the canonical names' keys and all alias keys."""
    keys = [T.normalize_label(F.col(name)) for name in names]
    payload = F.concat_ws("\n", entity_type, *keys, F.array_sort(F.array_distinct(alias_norms)))
    return hashed_ids(tags, payload, F.concat(F.col(entity_type), F.lit("_")), TAG_DIGITS, out)


def alias_rows(candidates: DataFrame, counts: DataFrame, blocked: DataFrame) -> DataFrame:
    """A row per tag, type and alias key.

    ``candidates``: tag, entity_type, alias, alias_latin, source, place (their order within a tag);
    ``counts``: tag, alias_norm, mention_count, document_count; ``blocked``: tag, alias_norm of aliases
    that name something else. Result: alias_id, tag, entity_type, alias, alias_norm, alias_latin,
    alias_source, alias_status, mention_count, document_count, conflict, needs_review, review_reasons.
    """
    text = F.trim(F.regexp_replace(T.text_or_empty(F.col("alias")), f"^{T.SPACES}|{T.SPACES}$", ""))
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source")), F.lit(0)), F.lit(99))
    rows = candidates.withColumn("alias", text).withColumn("alias_norm", T.normalize_label(F.col("alias"))).filter("alias_norm <> ''")
    best = F.min(F.struct(rank.alias("rank"), F.length("alias").alias("length"), "place", "alias", "alias_latin", "source"))
    once = rows.groupBy("tag", "entity_type", "alias_norm").agg(best.alias("best"))
    once = once.select("tag", "entity_type", "alias_norm", "best.alias", F.coalesce("best.alias_latin", F.lit("")).alias("alias_latin"), F.col("best.source").alias("alias_source"))
    once = hashed_ids(once, F.concat_ws("\n", "tag", "entity_type", "alias_norm"), F.lit("al_"), DIGITS, "alias_id")
    once = once.join(counts, ["tag", "alias_norm"], "left").join(blocked.select("tag", "alias_norm").distinct().withColumn("__blocked", F.lit(True)), ["tag", "alias_norm"], "left")
    held = F.coalesce("__blocked", F.lit(False))
    once = once.withColumn("alias_status", F.when(held, "blocked_active_substance_candidate").otherwise("active"))
    work = Workspace(candidates.sparkSession, "alias-rows")
    once = work.keep(once.drop("__blocked"), "once")
    torn = work.keep(conflicts(once), "conflicts")
    marked = once.join(torn.select("entity_type", "alias_norm", F.lit(True).alias("__torn")), ["entity_type", "alias_norm"], "left")
    conflict, blocked_too = F.coalesce("__torn", F.lit(False)), F.col("alias_status") != "active"
    reasons = T.flags(alias_conflict=conflict, blocked_active_substance_candidate=blocked_too)
    return marked.select(
        "alias_id", "tag", "entity_type", "alias", "alias_norm", "alias_latin", "alias_source", "alias_status", F.coalesce("mention_count", F.lit(0)).alias("mention_count"),
        F.coalesce("document_count", F.lit(0)).alias("document_count"), conflict.alias("conflict"), (conflict | blocked_too).alias("needs_review"), reasons.alias("review_reasons"),
    )


def conflicts(rows: DataFrame) -> DataFrame:
    """(entity_type, alias_norm, tags): keys that active aliases or their Latin forms of several tags have."""
    keys = F.array("alias_norm", T.normalize_label(F.col("alias_latin")))
    index = rows.filter("alias_status = 'active'").select("entity_type", "tag", F.explode(F.array_distinct(keys)).alias("alias_norm")).filter("alias_norm <> ''")
    found = index.groupBy("entity_type", "alias_norm").agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return found.filter(F.size("tags") > 1)


def uncovered(members: DataFrame, rows: DataFrame, tag: str = "tag") -> DataFrame:
    """Tags of ``members`` that have no alias."""
    return members.select(tag).distinct().join(rows.select(F.col("tag").alias(tag)).distinct(), tag, "left_anti")
