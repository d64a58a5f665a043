"""Label features, record checks, group verdicts, representatives and samples for review."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.functions import similarity as S
from lorekiln.functions import text as T
from lorekiln.operators import blocks, clusters, evidence, external, links, pairs, planning, quotes, windows
from lorekiln.plans.queries_matching import SQL_PAIRS, part_classes
from lorekiln.plans.queries_quotes import SQL_FOUND
from lorekiln.plans.queries_text import SQL_LINES
from lorekiln.plans.registry import Registry, table

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql

SQL_COLLAPSED = r"trim(regexp_replace(coalesce({0}, ''), '[ \t\n\r\f\x0B]+', ' ', 'g'))"


@REGISTRY.query(f"SELECT doc_id, left({SQL_COLLAPSED.format('text')}, 260) AS excerpt FROM documents")
def txt_content_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.excerpt(F.col("text")).alias("excerpt"))


_SQL_BARE = "label"
for _pattern in (T.DOSAGE, T.PACKAGING, T.DOSAGE, T.PACKAGING):
    _SQL_BARE = f"regexp_replace({_SQL_BARE}, '{_pattern}', ' ', 'g')"


@REGISTRY.query(f"""
    WITH l AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'ab ' ELSE lower(p_name) || ' ' END || p_size || ' мг таблетки № ' || p_size || CASE WHEN p_size % 3 = 0 THEN ' форте' ELSE '' END AS label FROM part),
    b AS (SELECT *, {SQL_COLLAPSED.format(_SQL_BARE)} AS bare FROM l), s AS (SELECT *, length(replace(bare, ' ', '')) < 3 AS too_short FROM b)
    SELECT p_partkey, CASE WHEN too_short THEN label ELSE bare END AS value, (CASE WHEN too_short THEN label ELSE bare END) <> label AS changed, too_short FROM s
""")
def txt_product_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels without doses and packages."""
    size, start = F.col("p_size").cast("string"), F.when(F.col("p_size") % 5 == 0, "ab ").otherwise(F.concat(F.lower("p_name"), F.lit(" ")))
    end = F.when(F.col("p_size") % 3 == 0, " форте").otherwise("")
    label = F.concat(start, size, F.lit(" мг таблетки № "), size, end)
    return table(spark, sf_dir, "part").select("p_partkey", T.product_name(label).alias("n")).select("p_partkey", "n.*")


@REGISTRY.query("""
    WITH l AS (SELECT p_partkey, p_name || CASE p_size % 5 WHEN 0 THEN ' type ' || p_size WHEN 1 THEN ' Type IV' WHEN 2 THEN ' type b' WHEN 3 THEN ' type' ELSE '' END AS label FROM part),
    f AS (SELECT p_partkey, lower(label) AS label, regexp_extract(lower(label), '(?:^| )type ([0-9]+|[ivx]+|[a-d])(?: |$)', 1) AS found FROM l)
    SELECT p_partkey, CASE WHEN found <> '' THEN 'type_' || found WHEN regexp_matches(label, '(^| )type( |$)') THEN 'type_marker' ELSE 'none' END AS subtype FROM f
""")
def txt_subtype_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, size = F.col("p_size") % 5, F.col("p_size").cast("string")
    end = F.when(kind == 0, F.concat(F.lit(" type "), size)).when(kind == 1, " Type IV").when(kind == 2, " type b").when(kind == 3, " type").otherwise("")
    return table(spark, sf_dir, "part").select("p_partkey", T.subtype(F.concat("p_name", end)).alias("subtype"))


@REGISTRY.query("""
    WITH r AS (SELECT d.doc_id, list_filter([CASE WHEN l.quality = 0 THEN 'Low_quality' END, CASE WHEN n_chars < 200 THEN 'short' END, CASE WHEN toxic = 1 THEN 'toxic' END,
        CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END], lambda x: x IS NOT NULL) AS r FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, array_to_string(list_filter(r, lambda x: contains(lower(x), 'quality') OR contains(lower(x), 'toxic')), ',') AS blocking,
        array_to_string(list_filter(r, lambda x: NOT (contains(lower(x), 'quality') OR contains(lower(x), 'toxic'))), ',') AS other FROM r
""")
def txt_split_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons that block publication and the others."""
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    reasons = T.flags(Low_quality=F.col("quality") == 0, short=F.col("n_chars") < 200, toxic=F.col("toxic") == 1, unlabelled=F.col("labelled").isNull())
    blocking, other = T.split_by_markers(reasons, ["quality", "toxic"])
    return docs.select("doc_id", F.array_join(blocking, ",").alias("blocking"), F.array_join(other, ",").alias("other"))


@REGISTRY.query(f"""
    WITH {SQL_PAIRS} SELECT left_id, right_id, CASE WHEN l.p_name = r.p_name THEN 'primary' WHEN l.p_brand = r.p_brand THEN 'alias' WHEN l.p_type = r.p_type THEN 'generic_only' ELSE 'none' END AS matched
    FROM pairs JOIN part l ON left_id = l.p_partkey JOIN part r ON right_id = r.p_partkey
""")
def sim_label_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    found = pairs.with_nodes(classes.pairs.drop("p_type"), classes.nodes, "cls", ["p_name", "p_brand", "p_type"])
    aliases = [F.array(f"{s}_p_brand", f"{s}_p_type") for s in "lr"]
    matched = S.label_match((F.col("l_p_name"), F.col("r_p_name")), (aliases[0], aliases[1]), F.array("l_p_type"))
    return classes.expanded(found.select("left_id", "right_id", matched.alias("matched")))


@REGISTRY.query()
def sim_title_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = part_classes(spark, sf_dir)
    found = pairs.with_nodes(classes.pairs, classes.nodes, "cls", ["p_name", "p_brand"])
    left, right = (F.concat_ws(" ", f"{s}_p_name", f"{s}_p_brand") for s in "lr")
    return classes.expanded(found.select("left_id", "right_id", S.title_close(left, right).alias("title_close")))


@REGISTRY.query(f"""
    WITH {SQL_FOUND}, x AS (SELECT q.item_id, coalesce(quote_status, 'not_found') AS s FROM q LEFT JOIN found USING (item_id))
    SELECT item_id, CASE WHEN bool_and(s = 'not_found') THEN 'not_found' WHEN bool_and(s = 'exact') THEN 'exact' WHEN bool_and(s <> 'not_found') THEN 'normalized_exact' ELSE 'partly_found' END AS status FROM x GROUP BY item_id
""")
def sim_quote_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One status per quote, from the distinct statuses of its hits."""
    asked = table(spark, sf_dir, "benchmark")
    hits = quotes.find_quotes(asked, "item_id", "text", table(spark, sf_dir, "documents"), "doc_id", "text", fuzzy=False)
    checked = asked.select("item_id").join(hits, "item_id", "left").select("item_id", F.coalesce("quote_status", F.lit("not_found")).alias("s"))
    return checked.groupBy("item_id").agg(S.rolled_up(F.collect_set("s")).alias("status"))


@REGISTRY.query("""
    WITH r AS (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS VARCHAR) END AS doc_id, value, CAST(json_extract(props, '$.k') AS INT) AS k, event_type FROM events),
    b AS (SELECT *, CASE WHEN value < 20 THEN 'invalid_json' WHEN doc_id IS NULL THEN 'missing_doc_id' WHEN k % 10 = 0 THEN 'entities_not_a_list' END AS broken FROM r)
    SELECT event_id, CASE WHEN value < 20 THEN NULL ELSE doc_id END AS doc_id, NULL::INT AS entity_index, broken AS invalid FROM b WHERE broken IS NOT NULL
    UNION ALL SELECT event_id, doc_id, 0, NULL FROM b WHERE broken IS NULL
    UNION ALL SELECT event_id, doc_id, 1, CASE WHEN k % 7 = 0 THEN 'entity_not_an_object' END FROM b WHERE broken IS NULL
""")
def gen_flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested records as rows, unusable ones with the reason."""
    k = F.get_json_object("props", "$.k").cast("int")
    entity = F.concat(F.lit('{"surface": "'), "event_type", F.lit('"}'))
    listed = F.when(k % 10 == 0, F.lit('"none"')).otherwise(F.concat(F.lit("["), entity, F.lit(", "), F.when(k % 7 == 0, F.lit("5")).otherwise(entity), F.lit("]")))
    start = F.when(F.col("event_type") == "error", F.lit("{")).otherwise(F.concat(F.lit('{"doc_id": '), F.col("user_id").cast("string"), F.lit(", ")))
    raw = F.when(F.col("value") < 20, F.lit('{"doc_id": ')).otherwise(F.concat(start, F.lit('"entities": '), listed, F.lit("}")))
    records = table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))
    return blocks.flat_records(records, "event_id", "raw").drop("entity")


@REGISTRY.query(rf"""
    WITH {SQL_LINES}, i AS (SELECT doc_id, block_index, block_type, CASE WHEN block_type = 'empty' THEN 'empty_block' WHEN block_type = 'list' AND trim(substr(text, 3)) = '' THEN 'empty_list_item'
        WHEN block_type = 'header' AND NOT regexp_matches(text, '\p{{L}}') THEN 'header_without_letters' END AS issue FROM blocks)
    SELECT * FROM i WHERE issue IS NOT NULL
""")
def val_block_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.block_issues(blocks.line_blocks(table(spark, sf_dir, "documents"))).select("doc_id", "block_index", "block_type", "issue")


@REGISTRY.query("""
    SELECT event_id, CASE WHEN value < 20 THEN 'not_json' WHEN value < 50 THEN 'not_an_object' ELSE 'ok' END AS status, length(CASE WHEN value < 20 THEN '{"k"' WHEN value < 50 THEN '[1]' ELSE props END) AS body_length FROM events
""")
def udf_parse_object(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in code fences that have to be objects."""
    body = F.when(F.col("value") < 20, F.lit('{"k"')).when(F.col("value") < 50, F.lit("[1]")).otherwise(F.col("props"))
    answers = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("answer"))
    bare, status = external.object_of(F.col("answer"))
    return answers.select("event_id", status.alias("status"), F.length(bare).alias("body_length"))


@REGISTRY.query("""
    SELECT p_partkey, min(l_suppkey) AS l_suppkey, greatest(count(DISTINCT l_suppkey) - 1, 0) AS other_clusters FROM part LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey
""")
def jn_mention_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey")
    return links.first_cluster(table(spark, sf_dir, "part"), members, "p_partkey", "l_suppkey")


@REGISTRY.query("""
    WITH n AS (SELECT p_partkey, CASE WHEN p_size > 2 THEN p_brand END AS brand, p_type FROM part WHERE p_size < 48),
    s AS (SELECT l_orderkey, bool_or(p_partkey IS NULL) AS lost, bool_or(p_partkey IS NOT NULL AND brand IS NULL) AS unplaced, count(DISTINCT p_type) AS kinds, count(DISTINCT brand) AS clusters_count,
        min(brand) AS first_cluster, max(brand) AS last_cluster FROM lineitem LEFT JOIN n ON l_partkey = p_partkey GROUP BY l_orderkey)
    SELECT l_orderkey, clusters_count, first_cluster, last_cluster, CASE WHEN lost THEN 'unknown_node' WHEN unplaced THEN 'unknown_cluster' WHEN kinds > 2 THEN 'cross_type' WHEN clusters_count < 2 THEN 'no_edge' ELSE 'edge' END AS verdict FROM s
""")
def jn_group_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = table(spark, sf_dir, "part").filter("p_size < 48").select(F.col("p_partkey").alias("l_partkey"), F.when(F.col("p_size") > 2, F.col("p_brand")).alias("brand"), "p_type")
    return links.group_edges(table(spark, sf_dir, "lineitem"), nodes, "l_orderkey", "l_partkey", "brand", "p_type", 2)


@REGISTRY.query("""
    WITH t AS (SELECT DISTINCT user_id, event_type FROM events WHERE value > 60)
    SELECT user_id, event_type, NOT EXISTS (SELECT 1 FROM t o WHERE o.user_id = t.user_id AND o.event_type <> t.event_type) AS sole FROM t
""")
def jn_sole_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.sole_candidates(table(spark, sf_dir, "events").withColumn("wanted", F.col("value") > 60), "user_id", "event_type", "wanted")


@REGISTRY.query("""
    SELECT l_orderkey, l_linenumber, CASE WHEN o_orderkey IS NULL THEN 'unknown_task' WHEN l_linestatus <> o_orderstatus THEN 'tag_mismatch' ELSE 'ok' END AS task_check FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
""")
def jn_tag_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    state = F.when(F.col("o_orderkey").isNull(), "unknown_task").when(F.col("l_linestatus") != F.col("o_orderstatus"), "tag_mismatch").otherwise("ok")
    return found.select("l_orderkey", "l_linenumber", state.alias("task_check"))


@REGISTRY.query("SELECT event_type, user_id, min(event_id) AS first_seen, count(*) AS mentions_count FROM events GROUP BY ALL")
def agg_first_seen_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.first_seen(table(spark, sf_dir, "events"), ["event_type", "user_id"], "event_id")


@REGISTRY.query("SELECT l_partkey, count(DISTINCT l_suppkey) AS groups_count FROM lineitem GROUP BY l_partkey ORDER BY groups_count DESC, l_partkey LIMIT 25")
def agg_hub_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.busiest_nodes(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey")


@REGISTRY.query("""
    WITH d AS (SELECT d.doc_id, lang, source, n_chars, coalesce(l.quality = 1, FALSE) AS valid, coalesce(l.quality = 0, FALSE) AS review, coalesce(l.quality, -1) AS q FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    r AS (SELECT lang, source, doc_id FROM d QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY q DESC, n_chars, doc_id) = 1),
    g AS (SELECT lang, source, count(*) AS rows_count, count(*) FILTER (WHERE valid) AS valid_count, count(*) FILTER (WHERE review) AS review_count FROM d GROUP BY ALL)
    SELECT g.*, r.doc_id AS representative, CASE WHEN valid_count = 0 AND review_count > 0 THEN 'review_only' WHEN valid_count = 0 THEN 'not_usable' WHEN valid_count >= 2 THEN 'core_fact' ELSE 'supporting_fact' END AS usage
    FROM g JOIN r ON g.lang IS NOT DISTINCT FROM r.lang AND g.source IS NOT DISTINCT FROM r.source
""")
def agg_fact_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    docs = docs.withColumn("valid", F.coalesce(F.col("quality") == 1, F.lit(False))).withColumn("review", F.coalesce(F.col("quality") == 0, F.lit(False)))
    rank = [-F.coalesce("quality", F.lit(-1)), F.col("n_chars")]
    return clusters.represented(docs, ["lang", "source"], rank, "doc_id", "valid", "review")


@REGISTRY.query("""
    WITH h AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN turn END AS place FROM conversations),
    w AS (SELECT conv_id, turn, list(place) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS inside,
        max(place) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS before FROM h)
    SELECT conv_id, turn, array_to_string(list_sort(list_distinct(list_filter(list_concat(inside, [before]), lambda x: x IS NOT NULL))), ',') AS headings FROM w
""")
def win_heading_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = windows.heading_context(table(spark, sf_dir, "conversations"), ["conv_id"], "turn", F.col("role") == "user", 1)
    return turns.select("conv_id", "turn", F.array_join(F.transform("headings", lambda h: h.cast("string")), ",").alias("headings"))


@REGISTRY.query("""
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY (p_type <> 'ECONOMY'), p_size DESC, p_partkey) AS k FROM part)
    SELECT p_brand, max(CASE WHEN k = 1 THEN p_name END) AS canonical, max(CASE WHEN k = 1 THEN p_type = 'ECONOMY' END) AS preferred, count(DISTINCT lower(p_name)) > 1 AS conflict FROM p GROUP BY p_brand
""")
def win_canonical_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label of the preferred kind if there is one, else of any; and whether labels differ."""
    kind = F.col("p_type") != "ECONOMY"
    first = F.min(F.struct(kind.alias("other"), (-F.col("p_size")).alias("size"), "p_partkey", "p_name"))
    found = table(spark, sf_dir, "part").groupBy("p_brand").agg(first.alias("first"), F.countDistinct(F.lower("p_name")).alias("n"))
    return found.select("p_brand", F.col("first.p_name").alias("canonical"), (~F.col("first.other")).alias("preferred"), (F.col("n") > 1).alias("conflict"))


@REGISTRY.query("""
    WITH d AS (SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'unlabelled' WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'poor' ELSE 'good' END AS category FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT category, doc_id, row_number() OVER (PARTITION BY category ORDER BY doc_id) AS sample_rank FROM d QUALIFY sample_rank <= 20
""")
def top_qa_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    category = F.when(F.col("labelled").isNull(), "unlabelled").when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").otherwise("good")
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(category.alias("category"), "doc_id")
    return windows.first_of_each(docs, "category", [F.col("doc_id")], 20)


@REGISTRY.query("""
    WITH t AS (SELECT c_custkey, c_mktsegment, c_acctbal FROM customer), v AS (SELECT c_custkey FROM t ORDER BY c_acctbal DESC, c_custkey LIMIT 10),
    r AS (SELECT c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS k FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM v))
    SELECT c_custkey, 'volume' AS picked_by FROM v UNION ALL SELECT c_custkey, 'group' FROM r WHERE k <= 3
""")
def top_smoke_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.smoke_selection(table(spark, sf_dir, "customer"), "c_custkey", "c_mktsegment", "c_acctbal", 10, 3)


@REGISTRY.query("""
    WITH d AS (SELECT CASE WHEN n_chars < 20 OR coalesce(toxic = 1, FALSE) THEN 'rejected' WHEN quality IS NULL OR quality = 0 THEN 'review' ELSE 'valid' END AS layer FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT count(*) AS rows_count, count(*) FILTER (WHERE layer = 'valid') AS valid_count, count(*) FILTER (WHERE layer = 'review') AS review_count, count(*) FILTER (WHERE layer = 'rejected') AS rejected_count, TRUE AS whole FROM d
""")
def set_layer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three disjoint layers that make up the input."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    layer, _ = evidence.evidence_layer({"short": F.col("n_chars") < 20, "toxic": F.col("toxic") == 1}, {"poor": F.col("quality") == 0, "unlabelled": F.col("quality").isNull()})
    counts = [F.count_if(F.col("layer") == name).alias(f"{name}_count") for name in ("valid", "review", "rejected")]
    found = docs.select(layer.alias("layer")).agg(F.count("*").alias("rows_count"), *counts)
    return found.withColumn("whole", F.col("valid_count") + F.col("review_count") + F.col("rejected_count") == F.col("rows_count"))


@REGISTRY.query("""
    WITH RECURSIVE d AS (SELECT conv_id, turn, length(text) AS n, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations),
    f AS (
        SELECT conv_id, turn, k, n, 0 AS batch, 1 AS rows_in, n AS total FROM d WHERE k = 1
        UNION ALL SELECT d.conv_id, d.turn, d.k, d.n,
            CASE WHEN f.n > 350 OR d.n > 350 OR f.rows_in >= 2 OR f.total + d.n > 700 THEN f.batch + 1 ELSE f.batch END,
            CASE WHEN f.n > 350 OR d.n > 350 OR f.rows_in >= 2 OR f.total + d.n > 700 THEN 1 ELSE f.rows_in + 1 END,
            CASE WHEN f.n > 350 OR d.n > 350 OR f.rows_in >= 2 OR f.total + d.n > 700 THEN d.n ELSE f.total + d.n END
        FROM f JOIN d ON f.conv_id = d.conv_id AND d.k = f.k + 1
    ) SELECT conv_id, turn, batch FROM f
""")
def grf_bin_fill_oversized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most two rows; a row over half of the size goes alone."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"))
    return windows.bin_fill(turns, "conv_id", "turn", "n", 2, 700, alone_over=350)


@REGISTRY.query("""
    WITH g AS (SELECT l_orderkey, count(*) FILTER (WHERE l_tax >= 0.08) AS blocked, count(*) AS size, round(1 - avg(l_discount), 6) AS score FROM lineitem GROUP BY l_orderkey),
    s AS (SELECT *, CASE WHEN blocked > 0 THEN 'blocked' WHEN size < 2 THEN 'singleton' WHEN size > 6 THEN 'too_large' WHEN score >= 0.94 THEN 'ready' ELSE 'low_confidence' END AS status FROM g)
    SELECT l_orderkey, status, CASE WHEN status <> 'ready' THEN 'none' WHEN score >= 0.97 THEN 'high' ELSE 'normal' END AS priority FROM s
""")
def cls_group_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_tax") >= 0.08).alias("blocked"), F.count("*").alias("size"), F.round(1 - F.avg("l_discount"), 6).alias("score")
    )
    status, priority = planning.group_status(F.col("blocked"), F.col("size"), F.col("score"), 6, 0.94)
    return groups.select("l_orderkey", status.alias("status"), priority.alias("priority"))
