"""Pairs, graphs, links and quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.operators import abbreviations, graph, links, pair_features, pairs
from lorekiln.plans.queries_text import SQL_KEY, SQL_TOKENS
from lorekiln.plans.registry import Registry, table
from lorekiln.sources.shared import Workspace

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql

CAPS = {"brand_name": 250, "name_size": 250, "brand_type_size": 1000}

SQL_PAIRS = """
    nodes AS (SELECT p_partkey AS id, p_name, p_brand, p_type, p_size FROM part),
    keyed AS (
        SELECT id, p_type, 'brand_name' AS bucket, p_brand || '|' || p_name AS key FROM nodes
        UNION ALL SELECT id, p_type, 'name_size', p_name || '|' || p_size FROM nodes
        UNION ALL SELECT id, p_type, 'brand_type_size', p_brand || '|' || p_size FROM nodes
    ), kept AS (
        SELECT p_type, bucket, key FROM keyed GROUP BY ALL
        HAVING count(*) > 1 AND count(*) <= CASE bucket WHEN 'brand_type_size' THEN 1000 ELSE 250 END
    ), usable AS (SELECT keyed.* FROM keyed JOIN kept USING (p_type, bucket, key)),
    pairs AS (
        SELECT l.p_type, l.id AS left_id, r.id AS right_id, array_to_string(list_sort(list(DISTINCT l.bucket)), ',') AS reasons
        FROM usable l JOIN usable r ON l.p_type = r.p_type AND l.bucket = r.bucket AND l.key = r.key AND l.id < r.id GROUP BY ALL
    )
"""
SQL_SCORED = f"""
    {SQL_PAIRS}, joined AS (
        SELECT p.*, l.p_name AS l_name, r.p_name AS r_name, l.p_brand AS l_brand, r.p_brand AS r_brand, l.p_size AS l_size, r.p_size AS r_size,
            {SQL_TOKENS.format('l.p_name')} AS l_tokens, {SQL_TOKENS.format('r.p_name')} AS r_tokens
        FROM pairs p JOIN part l ON p.left_id = l.p_partkey JOIN part r ON p.right_id = r.p_partkey
    ), scored AS (
        SELECT *, len(list_intersect(l_tokens, r_tokens)) / len(list_distinct(list_concat(l_tokens, r_tokens))) AS jaccard FROM joined
    ), rated AS (
        SELECT *, round(0.5 * jaccard + CASE WHEN l_brand = r_brand THEN 0.3 ELSE 0 END + CASE WHEN l_size = r_size THEN 0.2 ELSE 0 END, 6) AS score FROM scored
    )
"""


def _part_keys() -> dict[str, Column]:
    return {
        "brand_name": F.concat("p_brand", F.lit("|"), "p_name"),
        "name_size": F.concat("p_name", F.lit("|"), F.col("p_size").cast("string")),
        "brand_type_size": F.concat("p_brand", F.lit("|"), F.col("p_size").cast("string")),
    }


def part_classes(spark: SparkSession, sf_dir: str) -> pairs.PairClasses:
    """Parts that are alike but for their keys are a class."""
    return pairs.PairClasses(table(spark, sf_dir, "part"), "p_partkey", "p_type", _part_keys(), CAPS, ["p_type", "p_name", "p_brand", "p_size"])


def _rated(classes: pairs.PairClasses) -> DataFrame:
    """Pairs of classes with their scores."""
    joined = pairs.with_nodes(classes.pairs, classes.nodes, "cls", ["p_name", "p_brand", "p_size"])
    jaccard = S.token_jaccard(T.tokens(F.col("l_p_name")), T.tokens(F.col("r_p_name")))
    score = 0.5 * F.col("jaccard") + F.when(F.col("l_p_brand") == F.col("r_p_brand"), 0.3).otherwise(0.0) + F.when(F.col("l_p_size") == F.col("r_p_size"), 0.2).otherwise(0.0)
    return joined.withColumn("jaccard", jaccard).withColumn("score", F.round(score, 6))


@REGISTRY.query(f"WITH {SQL_PAIRS} SELECT * FROM pairs")
def jn_blocked_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    return classes.expanded(classes.pairs.select("p_type", "left_id", "right_id", "reasons"))


@REGISTRY.query("""
    WITH k AS (
        SELECT p_partkey AS id, p_type, 'brand_name' AS bucket, p_brand || '|' || p_name AS key FROM part
        UNION ALL SELECT p_partkey, p_type, 'type_only', p_type FROM part
    ) SELECT p_type, bucket, key, count(*) AS n FROM k GROUP BY ALL HAVING count(*) > CASE bucket WHEN 'brand_name' THEN 3 ELSE 100 END
""")
def jn_skipped_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets over their caps, which make no pairs."""
    keys = {"brand_name": F.concat("p_brand", F.lit("|"), "p_name"), "type_only": F.col("p_type")}
    return pairs.skipped_buckets(table(spark, sf_dir, "part"), "p_partkey", "p_type", keys, {"brand_name": 3, "type_only": 100})


@REGISTRY.query(f"WITH {SQL_SCORED} SELECT left_id, right_id, round(jaccard, 6) AS jaccard, score FROM rated")
def sim_pair_scores_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    return classes.expanded(_rated(classes).select("left_id", "right_id", F.round("jaccard", 6).alias("jaccard"), "score"))


@REGISTRY.query()
def sim_pair_scores_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    rated = _rated(classes)
    label = [F.concat_ws(" ", f"{s}_p_brand", f"{s}_p_name") for s in "lr"]
    ratio = S.ratio(*label, 0.78)
    bonus = F.when(F.col("ratio") >= 0.88, 0.2).when(F.col("ratio") >= 0.78, 0.12).otherwise(0.0)
    found = rated.withColumn("ratio", F.round(ratio, 6)).select("left_id", "right_id", "ratio", F.round(F.least(F.lit(1.0), F.col("score") + bonus), 6).alias("score"))
    return classes.expanded(found)


@REGISTRY.query(f"""
    WITH {SQL_SCORED} SELECT p_type, left_id, right_id, score, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY score DESC, left_id, right_id) AS rank FROM rated) WHERE rank <= 100
""")
def jn_topk_pairs_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    return classes.top(_rated(classes), "score", 100).select("p_type", "left_id", "right_id", "score", "rank")


@REGISTRY.query(f"""
    WITH {SQL_SCORED} SELECT left_id, right_id, CASE WHEN l_size % 2 <> r_size % 2 THEN 'blocked' WHEN score >= 0.88 THEN 'high_priority_candidate'
        WHEN score >= 0.72 THEN 'low_confidence_candidate' ELSE 'rejected_low_score' END AS pair_status FROM rated
""")
def cls_pair_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    vetoed = F.col("l_p_size") % 2 != F.col("r_p_size") % 2
    classes = part_classes(spark, sf_dir)
    return classes.expanded(_rated(classes).select("left_id", "right_id", pairs.pair_status(F.col("score"), vetoed, 0.72, 0.88).alias("pair_status")))


@REGISTRY.query()
def grf_clique_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of classes are those of their nodes, as scores are the same in both orders; a component's
    pairs of nodes are made where it is folded."""
    work = Workspace(spark, "clique-groups")
    classes = part_classes(spark, sf_dir)
    good = work.keep(_rated(classes).filter("score >= 0.88").select("p_type", "left_id", "right_id", "score"), "pairs")
    labels = graph.connected_components(good, Workspace(spark, "clique-components"), "left_id", "right_id")
    found = good.join(labels, good["left_id"] == labels["node"]).drop("node")
    return pairs.clique_groups(classes.with_members(found), "p_type", "score")


@REGISTRY.query("""
    WITH m AS (SELECT DISTINCT l_suppkey AS grp, l_partkey AS node FROM lineitem),
    b AS (SELECT node, count(DISTINCT grp) AS n FROM m GROUP BY node)
    SELECT grp, count(*) AS nodes_count, max(n) AS busiest, CASE WHEN max(n) > 42 THEN 'demoted' ELSE 'ready' END AS status
    FROM m JOIN b USING (node) GROUP BY grp
""")
def grf_hub_protection(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("grp"), F.col("l_partkey").alias("node"))
    return pairs.hub_protection(members, "grp", "node", 42)


@REGISTRY.query("""
    WITH RECURSIVE e AS (
        SELECT c_custkey + 1000000000 AS a, c_nationkey + 3000000000 AS b FROM customer
        UNION SELECT s_suppkey + 2000000000, s_nationkey + 3000000000 FROM supplier
        UNION SELECT n_nationkey + 3000000000, n_regionkey + 4000000000 FROM nation
    ), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    reach AS (SELECT a AS node, a AS other FROM both_ways UNION SELECT r.node, w.b FROM reach r JOIN both_ways w ON r.other = w.a)
    SELECT node, min(other) AS component FROM reach GROUP BY node
""")
def grf_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    def edges(name: str, left: str, first: int, right: str, second: int) -> DataFrame:
        own = table(spark, sf_dir, name)
        return own.select((F.col(left).cast("long") + first).alias("src"), (F.col(right).cast("long") + second).alias("dst"))

    every = edges("customer", "c_custkey", 1_000_000_000, "c_nationkey", 3_000_000_000)
    every = every.union(edges("supplier", "s_suppkey", 2_000_000_000, "s_nationkey", 3_000_000_000))
    every = every.union(edges("nation", "n_nationkey", 3_000_000_000, "n_regionkey", 4_000_000_000))
    return graph.connected_components(every, Workspace(spark, "components"))


@REGISTRY.query("""
    WITH e AS (SELECT l_orderkey AS edge, l_partkey AS node, max(l_discount) OVER (PARTITION BY l_orderkey) AS c FROM lineitem),
    r AS (SELECT DISTINCT l_orderkey AS rid, l_partkey AS node FROM lineitem WHERE l_returnflag = 'R'),
    s AS (SELECT rid, count(*) AS wanted FROM r GROUP BY rid),
    w AS (SELECT DISTINCT edge, node FROM e WHERE c < 0.09),
    h AS (SELECT edge, rid, count(*) AS held FROM w JOIN r USING (node) GROUP BY ALL),
    v AS (SELECT DISTINCT edge FROM h JOIN s USING (rid) WHERE held = wanted)
    SELECT d.edge, v.edge IS NOT NULL AS vetoed FROM (SELECT DISTINCT edge FROM e) d LEFT JOIN v USING (edge)
""")
def grf_constraint_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    best = items.groupBy("l_orderkey").agg(F.max("l_discount").alias("c"))
    edges = items.join(best, "l_orderkey").select(F.col("l_orderkey").alias("edge"), F.col("l_partkey").alias("node"), "c")
    rejected = items.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("rid"), F.col("l_partkey").alias("node"))
    return pairs.constraint_veto(edges, rejected, "edge", "node", "c", "rid", 0.09)


@REGISTRY.query("SELECT d.doc_id, d.source, l.quality, coalesce(l.toxic, 0) AS toxic, l.doc_id IS NULL AS unlinked FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def jn_links_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("linked", F.lit(True))
    found = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    return found.select("doc_id", "source", "quality", F.coalesce("toxic", F.lit(0)).alias("toxic"), F.col("linked").isNull().alias("unlinked"))


@REGISTRY.query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def jn_missing_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left_anti").select("doc_id", "lang")


@REGISTRY.query("SELECT p_name AS alias, count(DISTINCT p_brand) AS tags_count, min(p_brand) AS first_tag FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) > 1")
def jn_alias_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.alias_conflicts(table(spark, sf_dir, "part").withColumnRenamed("p_name", "alias"), "alias", "p_brand")


@REGISTRY.query("""
    SELECT p_brand, p_name, p_partkey FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'STANDARD' THEN 1 ELSE 2 END, p_size, p_partkey) = 1
""")
def win_alias_dedupe_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("p_type") == "ECONOMY", 0).when(F.col("p_type") == "STANDARD", 1).otherwise(2)
    return links.first_per_key(table(spark, sf_dir, "part"), ["p_brand", "p_name"], [priority, F.col("p_size"), F.col("p_partkey")]).select("p_brand", "p_name", "p_partkey")


SQL_HITS = f"""
    q AS (SELECT item_id, ' ' || {SQL_KEY.format('text')} || ' ' AS q FROM benchmark),
    d AS (SELECT doc_id, ' ' || {SQL_KEY.format('text')} || ' ' AS body FROM documents),
    hits AS (SELECT item_id, doc_id FROM q JOIN d ON contains(body, q) WHERE trim(q) <> '')
"""
SQL_ALIASES = r"""
    w AS (SELECT item_id, lower(regexp_extract(text, '[\p{L}\p{N}_]+')) AS alias FROM benchmark),
    words AS (SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+'))) AS word FROM documents),
    alias_hits AS (SELECT DISTINCT item_id, doc_id FROM w JOIN words ON word = alias WHERE length(alias) >= 3)
"""


def _quote_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.quote_hits(table(spark, sf_dir, "benchmark"), "item_id", "text", table(spark, sf_dir, "documents"), "doc_id", "text")


def _alias_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = table(spark, sf_dir, "benchmark").select("item_id", F.regexp_extract("text", T.WORD, 0).alias("alias"))
    return links.alias_hits(aliases, "item_id", "alias", table(spark, sf_dir, "documents"), "doc_id", "text")


@REGISTRY.query(f"WITH {SQL_HITS} SELECT DISTINCT item_id, doc_id FROM hits")
def jn_quote_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quote_hits(spark, sf_dir)


@REGISTRY.query(f"WITH {SQL_ALIASES} SELECT item_id, doc_id FROM alias_hits")
def jn_alias_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alias_hits(spark, sf_dir)


@REGISTRY.query(f"""
    WITH {SQL_HITS}, {SQL_ALIASES}, a AS (
        SELECT doc_id, 0 AS rank, 'quote' AS method, count(*) AS hits FROM (SELECT DISTINCT item_id, doc_id FROM hits) GROUP BY doc_id
        UNION ALL SELECT doc_id, 1, 'alias', count(*) FROM alias_hits GROUP BY doc_id
        UNION ALL SELECT doc_id, 2, 'short_document', count(*) FROM documents WHERE length(text) < 500 GROUP BY doc_id
        UNION ALL SELECT doc_id, 3, 'mention_only', count(*) FROM documents GROUP BY doc_id
    ) SELECT doc_id, method, hits FROM a QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank) = 1
""")
def jn_match_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = [("quote", _quote_hits(spark, sf_dir)), ("alias", _alias_hits(spark, sf_dir)), ("short_document", docs.filter(F.length("text") < 500)), ("mention_only", docs)]
    return links.match_fallback(hits, ["doc_id"])


#: Letters of a part's name, as an alias in parentheses: what a maker might print beside its type.
SQL_ABBREVIATIONS = r"""
    n AS (SELECT p_partkey AS id, lower(p_name) AS a, lower(p_type || ' (' || p_brand || ')') AS b, lower(p_brand) AS inner_alias FROM part),
    w AS (SELECT *, list_transform(regexp_extract_all(a, '[\p{L}\p{N}_]+'), lambda x: x[1]) AS wa, list_transform(regexp_extract_all(b, '[\p{L}\p{N}_]+'), lambda x: x[1]) AS wb FROM n),
    f AS (SELECT id, list_distinct([a, b]) AS labels, list_distinct(list_concat([{'f': inner_alias, 's': 'explicit_parenthetical'}],
        CASE WHEN len(wa) BETWEEN 2 AND 6 THEN [{'f': array_to_string(wa, ''), 's': 'generated_acronym'}] ELSE [] END,
        CASE WHEN len(wb) BETWEEN 2 AND 6 THEN [{'f': array_to_string(wb, ''), 's': 'generated_acronym'}] ELSE [] END)) AS forms FROM w)
"""


@REGISTRY.query(f"""
    WITH {SQL_PAIRS}, {SQL_ABBREVIATIONS}, x AS (
        SELECT left_id, right_id, list_filter(l.forms, lambda p: list_contains(list_transform(r.forms, lambda q: q.f), p.f)) AS lf,
            list_filter(r.forms, lambda p: list_contains(list_transform(l.forms, lambda q: q.f), p.f)) AS rf
        FROM pairs JOIN f l ON l.id = left_id JOIN f r ON r.id = right_id
    ), y AS (SELECT left_id, right_id, list_distinct(list_transform(lf, lambda p: p.f)) AS fs, list_distinct(list_transform(list_concat(lf, rf), lambda p: p.s)) AS ss FROM x)
    SELECT left_id, right_id, array_to_string(list_sort(fs), ',') AS abbreviations, array_to_string(list_sort(ss), ',') AS sources,
        CASE WHEN len(fs) = 0 THEN 'none' WHEN list_contains(ss, 'explicit_parenthetical') THEN 'clean' ELSE 'weak' END AS abbreviation_match FROM y
""")
def sim_abbreviation_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short forms that two parts have in common, and what they are worth."""
    classes = part_classes(spark, sf_dir)
    nodes = classes.nodes.select("cls", "p_name", F.array(F.concat("p_type", F.lit(" ("), "p_brand", F.lit(")"))).alias("aliases"))
    work = Workspace(spark, "abbreviations")
    described = work.keep(abbreviations.described(nodes, "cls", "p_name", "aliases"), "described")
    found = abbreviations.judged(classes.pairs.select("left_id", "right_id"), described)
    joined = [F.array_join(c, ",").alias(c) for c in ("abbreviations", "sources")]
    return classes.expanded(found.select("left_id", "right_id", *joined, "abbreviation_match"))


@REGISTRY.query()
def sim_pair_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons and scores of all candidate pairs of parts; tests add them up one by one."""
    none = F.array().cast("array<string>")
    classes = part_classes(spark, sf_dir)
    nodes = classes.nodes.select(
        F.col("cls").alias("id"), F.col("p_name").alias("label"), F.array(F.concat("p_type", F.lit(" ("), "p_brand", F.lit(")"))).alias("aliases"), F.lit("supplement").alias("entity_type"),
        F.lit("").alias("latin"), F.concat_ws("|", "p_brand", "p_name").alias("product_key"), F.array(F.col("p_size").cast("string")).alias("documents"),
        F.when(F.col("p_size") % 9 == 0, F.array(F.lit("low_confidence"))).otherwise(none).alias("risk_flags"), F.lit(1).alias("mentions_count"), (F.col("p_size") % 2).alias("context_only_count"),
    )
    featured = Workspace(spark, "pair-features").keep(pair_features.featured(nodes), "nodes")
    found = pair_features.scored(classes.pairs.select("left_id", "right_id"), featured)
    joined = [F.array_join(c, ",").alias(c) for c in ("clean_reasons", "weak_reasons", "risk_reasons")]
    return classes.expanded(found.select("left_id", "right_id", "score", *joined, "token_similarity", "sequence_similarity"))
