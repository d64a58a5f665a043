"""Groups of equal keys and what is reported of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_mode(df: DataFrame, keys: list[str], value: str, out: str = "display") -> DataFrame:
    """The most frequent value of each group; then values not all in lower case, longer ones,
    and the first in order."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    lower = (F.col(value) == F.lower(value)).cast("int")
    best = F.min(F.struct((-F.col("n")).alias("n"), lower.alias("lower"), (-F.length(value)).alias("length"), F.col(value).alias("value")))
    return counts.groupBy(*keys).agg(best.alias("best")).select(*keys, F.col("best.value").alias(out), (-F.col("best.n")).alias("value_count"))


def exact_clusters(mentions: DataFrame, key: str, doc: str, alias: str, confidence: str) -> DataFrame:
    """Mentions of equal keys: counts, confidence, distinct documents and aliases, status."""
    grouped = mentions.groupBy(key).agg(
        F.count("*").alias("mentions_count"),
        F.countDistinct(doc).alias("documents_count"),
        F.round(F.min(confidence), 6).alias("confidence_min"),
        F.round(F.avg(confidence), 6).alias("confidence_avg"),
        F.round(F.max(confidence), 6).alias("confidence_max"),
        F.array_sort(F.collect_set(alias)).alias("aliases"),
    )
    status = F.when(F.col("mentions_count") == 1, "isolated_mention").when(F.col("confidence_min") < F.col("confidence_max"), "review_group").otherwise("auto_merged")
    return grouped.withColumn("cluster_status", status)


def frequent_values(df: DataFrame, keys: list[str], id_col: str, value: str, least: int, examples: int = 3) -> DataFrame:
    """Groups with at least ``least`` rows: count, mean and the first distinct examples. Only
    as many examples as are shown leave a task."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(id_col))
    shown = df.select(*keys, id_col).distinct().withColumn("at", first).filter(F.col("at") <= examples)
    shown = shown.groupBy(*keys).agg(F.array_sort(F.collect_list(id_col)).alias("examples"))
    counts = df.groupBy(*keys).agg(F.count("*").alias("rows_count"), F.round(F.avg(value), 6).alias("value_avg")).filter(F.col("rows_count") >= least)
    return counts.join(shown, keys)


def repeated_keys(df: DataFrame, key: Column, id_col: str) -> DataFrame:
    """Keys of several rows with the number and range of their ids."""
    grouped = df.groupBy(key.alias("key")).agg(F.count("*").alias("rows_count"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"))
    return grouped.filter("rows_count > 1")


def single_document_clusters(df: DataFrame, keys: list[str], doc: str, id_col: str, confidence: str, fast: float) -> DataFrame:
    """Clusters of one document with their representative, the most confident mention, and the
    number of clusters that share the document."""
    best = F.min(F.struct((-F.col(confidence)).alias("c"), F.col(id_col).alias("id"))).alias("best")
    grouped = df.groupBy(*keys).agg(F.countDistinct(doc).alias("docs"), F.min(doc).alias(doc), best).filter("docs = 1")
    rivals = grouped.groupBy(doc).agg(F.count("*").alias("clusters_in_document"))
    return grouped.join(rivals, doc).select(
        *keys, doc, F.col("best.id").alias("representative"), "clusters_in_document", ((-F.col("best.c")) >= fast).alias("fast_path")
    )


def reason_summary(df: DataFrame, reasons: str, keys: list[str], doc: str) -> DataFrame:
    """Rows and distinct documents per reason; rows without a reason count as unspecified."""
    some = F.when(F.size(reasons) > 0, F.col(reasons)).otherwise(F.array(F.lit("unspecified")))
    exploded = df.withColumn("reason", F.explode(some))
    return exploded.groupBy(*keys, "reason").agg(F.count("*").alias("rows_count"), F.countDistinct(doc).alias("documents_count"))


def tags_by_document(links: DataFrame, doc: str, tag: str, flag: str) -> DataFrame:
    """Per document its tags with whether any link of a tag has the flag, as ``tag:flag`` text."""
    pairs = links.groupBy(doc, tag).agg(F.bool_or(flag).alias("any"))
    text = F.concat_ws(":", F.col(tag), F.col("any").cast("string"))
    return pairs.groupBy(doc).agg(F.count("*").alias("tags_count"), F.array_join(F.array_sort(F.collect_list(text)), ",").alias("tags"))


def first_seen(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A row per key with its first place and number of rows, instead of arrays that grow with a tag."""
    return df.groupBy(*keys).agg(F.min(order).alias("first_seen"), F.count("*").alias("mentions_count"))


def busiest_nodes(members: DataFrame, group: str, node: str, most: int = 25) -> DataFrame:
    """The nodes that occur in most groups."""
    counts = members.groupBy(node).agg(F.countDistinct(group).alias("groups_count"))
    return counts.orderBy(F.col("groups_count").desc(), node).limit(most)


def represented(df: DataFrame, keys: list[str], rank: list, id_col: str, valid: str, review: str) -> DataFrame:
    """Groups with the id of their best row, counts of layers and how they may be used."""
    found = df.groupBy(*keys).agg(
        F.min(F.struct(*[r.alias(f"r{k}") for k, r in enumerate(rank)], F.col(id_col)))[id_col].alias("representative"),
        F.count("*").alias("rows_count"), F.count_if(valid).alias("valid_count"), F.count_if(review).alias("review_count"),
    )
    usage = F.when((F.col("valid_count") == 0) & (F.col("review_count") > 0), "review_only").when(F.col("valid_count") == 0, "not_usable")
    return found.withColumn("usage", usage.when(F.col("valid_count") >= 2, "core_fact").otherwise("supporting_fact"))
