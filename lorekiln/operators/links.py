"""Joins between mentions, aliases, quotes and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.functions import text as T

#: Words of a quote that lead to the documents it may stand in.
LEAD = 4


def alias_conflicts(aliases: DataFrame, alias: str, tag: str) -> DataFrame:
    """Aliases of several tags."""
    found = aliases.groupBy(alias).agg(F.countDistinct(tag).alias("tags_count"), F.min(tag).alias("first_tag"))
    return found.filter("tags_count > 1")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in order."""
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__at = 1").drop("__at")


def _leads(words: Column, n: int) -> Column:
    """All runs of ``n`` words."""
    runs = F.transform(words, lambda w, k: F.concat_ws(" ", w, *[F.get(words, k + j) for j in range(1, n)]))
    return F.slice(runs, F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(0)))


def quote_hits(quotes: DataFrame, quote_id: str, quote: str, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(quote id, document id) where the quote's words stand in the document in a row.

    A quote's leading words are an equi-join key, so no text meets all quotes. Only ids and
    hashes of word runs are exploded and shuffled; texts are fetched for the pairs that remain,
    and the whole quote is looked up there. Quotes shorter than that join by all their words.
    """
    asked = quotes.select(F.col(quote_id).alias("__quote_id"), T.match_key(F.col(quote)).alias("__quote")).filter("__quote <> ''")
    words = F.split("__quote", " ")
    asked = asked.withColumn("__n", F.least(F.size(words), F.lit(LEAD)))
    lead = F.array_join(F.slice(words, F.lit(1), F.col("__n")), " ")
    lengths = sorted(r[0] for r in asked.select("__n").distinct().collect())  # LEAD values at most
    body = docs.select(F.col(doc_id).alias("__doc_id"), T.match_key(F.col(text)).alias("__body"))
    leads = [_leads(F.col("__words"), n) for n in lengths] or [F.array().cast("array<string>")]
    places = _exploded(body.select("__doc_id", F.split("__body", " ").alias("__words")), "__doc_id", F.concat(*leads))
    pairs = places.join(asked.select("__quote_id", F.xxhash64(lead).alias("__run")), "__run").select("__quote_id", "__doc_id").distinct()
    padded = F.contains(F.concat(F.lit(" "), F.col("__body"), F.lit(" ")), F.concat(F.lit(" "), F.col("__quote"), F.lit(" ")))
    hits = pairs.join(asked.select("__quote_id", "__quote"), "__quote_id").join(body, "__doc_id").filter(padded)
    return hits.select(F.col("__quote_id").alias(quote_id), F.col("__doc_id").alias(doc_id)).distinct()


def _exploded(rows: DataFrame, key: str, runs: Column) -> DataFrame:
    """(key, __run): hashes of the distinct runs of words of each row."""
    return rows.select(key, F.explode(F.array_distinct(F.transform(runs, lambda r: F.xxhash64(r)))).alias("__run"))


def alias_hits(aliases: DataFrame, alias_id: str, alias: str, docs: DataFrame, doc_id: str, text: str, least: int = 3) -> DataFrame:
    """(alias id, document id) where a one-word alias is a word of the document."""
    asked = aliases.select(alias_id, F.lower(F.col(alias)).alias("word")).filter(F.length("word") >= least)
    words = docs.select(doc_id, F.explode(T.tokens(F.col(text))).alias("word"))
    return words.join(asked, "word").select(alias_id, doc_id).distinct()


def match_fallback(hits: list[tuple[str, DataFrame]], keys: list[str]) -> DataFrame:
    """Per key the first method in the list that has hits, with their number."""
    every = None
    for rank, (method, found) in enumerate(hits):
        own = found.groupBy(*keys).agg(F.count("*").alias("hits")).withColumn("rank", F.lit(rank)).withColumn("method", F.lit(method))
        every = own if every is None else every.unionByName(own)
    best = F.min(F.struct("rank", "method", "hits")).alias("best")
    return every.groupBy(*keys).agg(best).select(*keys, F.col("best.method").alias("method"), F.col("best.hits").alias("hits"))


def first_cluster(mentions: DataFrame, members: DataFrame, mention: str, cluster: str) -> DataFrame:
    """(mention, cluster, other_clusters): the first cluster that claims a mention wins; mentions
    that none claims have no cluster."""
    claimed = members.groupBy(F.col(mention).alias("__mention")).agg(F.min(cluster).alias(cluster), (F.countDistinct(cluster) - 1).alias("other_clusters"))
    found = mentions.select(mention).join(claimed, F.col(mention) == F.col("__mention"), "left")
    return found.select(mention, cluster, F.coalesce("other_clusters", F.lit(0)).alias("other_clusters"))


def group_edges(members: DataFrame, nodes: DataFrame, group: str, node: str, cluster: str, kind: str, most_kinds: int = 1) -> DataFrame:
    """(group, clusters_count, first_cluster, last_cluster, verdict) of accepted groups. The first
    verdict that holds: unknown_node, unknown_cluster, cross_type, no_edge (one cluster), edge."""
    known = nodes.select(F.col(node).alias("__node"), cluster, kind)
    # Repeated rows change none of these, and sets of clusters and kinds need no copies of the rows.
    found = members.select(group, node).join(known, F.col(node) == F.col("__node"), "left")
    sums = found.groupBy(group).agg(
        F.bool_or(F.col("__node").isNull()).alias("lost"), F.bool_or(F.col("__node").isNotNull() & F.col(cluster).isNull()).alias("unplaced"),
        F.size(F.collect_set(kind)).alias("kinds"), F.size(F.collect_set(cluster)).cast("long").alias("clusters_count"),
        F.min(cluster).alias("first_cluster"), F.max(cluster).alias("last_cluster"),
    )
    verdict = F.when(F.col("lost"), "unknown_node").when(F.col("unplaced"), "unknown_cluster").when(F.col("kinds") > most_kinds, "cross_type")
    verdict = verdict.when(F.col("clusters_count") < 2, "no_edge").otherwise("edge")
    return sums.select(group, "clusters_count", "first_cluster", "last_cluster", verdict.alias("verdict"))


def sole_candidates(links: DataFrame, doc: str, tag: str, candidate: str) -> DataFrame:
    """(doc, tag, sole): candidate tags of a document, and whether no other tag competes."""
    tags = links.filter(candidate).select(doc, tag).distinct()
    alone = tags.groupBy(doc).agg((F.count("*") == 1).alias("sole"))
    return tags.join(alone, doc)
