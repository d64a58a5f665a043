"""Windows, plans, evidence, samples, resume and quality gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators import evidence, external, facts, planning, windows
from lorekiln.plans.queries_text import SQL_KEY
from lorekiln.plans.registry import Registry, table

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql


@REGISTRY.query("""
    SELECT c.conv_id, c.turn, c.role FROM conversations c WHERE EXISTS (
        SELECT 1 FROM conversations h WHERE h.conv_id = c.conv_id AND length(h.text) > 500 AND h.turn BETWEEN c.turn - 2 AND c.turn + 2)
""")
def win_neighbour_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return windows.neighbour_frame(turns, ["conv_id"], "turn", F.length("text") > 500, 2).select("conv_id", "turn", "role")


@REGISTRY.query("""
    SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN turn END) OVER (
        PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_header FROM conversations
""")
def win_previous_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return windows.previous_header(turns, ["conv_id"], "turn", F.col("role") == "user").select("conv_id", "turn", "previous_header")


@REGISTRY.query("""
    WITH h AS (SELECT user_id, epoch(ts)::BIGINT AS b, epoch(ts)::BIGINT + 600 AS e FROM (SELECT user_id, date_trunc('second', ts) AS ts FROM events)),
    m AS (SELECT *, CASE WHEN max(e) OVER w IS NULL OR b > max(e) OVER w + 60 THEN 1 ELSE 0 END AS fresh FROM h
        WINDOW w AS (PARTITION BY user_id ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY b, e) AS island FROM m)
    SELECT user_id, min(b) AS island_begin, max(e) AS island_end, count(*) AS members FROM i GROUP BY user_id, island
""")
def win_merge_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    begin = F.unix_seconds(F.col("ts").cast("timestamp"))
    spans = table(spark, sf_dir, "events").select("user_id", begin.alias("b"), (begin + 600).alias("e"))
    return windows.merged_islands(spans, ["user_id"], "b", "e", gap=60)


@REGISTRY.query("""
    WITH c AS (SELECT conv_id, turn, length(text) AS n, 2 AS centre FROM conversations),
    u AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY abs(turn - centre), turn ROWS UNBOUNDED PRECEDING) AS used FROM c)
    SELECT conv_id, turn, n FROM u WHERE used <= 1500 OR turn = centre
""")
def win_trim_to_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").alias("n"), F.lit(2).alias("centre"))
    return windows.trim_to_budget(turns, ["conv_id"], "turn", "centre", "n", 1500).select("conv_id", "turn", "n")


SQL_PLANS = """
    o AS (SELECT o_custkey, count(*) AS docs, max(o_totalprice) / sum(o_totalprice) AS coverage, bool_or(o_orderpriority = '1-URGENT') AS urgent FROM orders GROUP BY o_custkey),
    p AS (SELECT c_custkey, c_mktsegment, coalesce(o.docs, 0) AS docs, c_acctbal >= 0 AS candidate, coalesce(o.urgent, FALSE) AS review, coalesce(o.coverage, 0) AS coverage
        FROM customer LEFT JOIN o ON c_custkey = o_custkey),
    s AS (SELECT *, CASE WHEN docs = 0 THEN 'stub_only' WHEN review AND NOT candidate THEN 'review_stub' WHEN NOT candidate THEN 'context_stub'
        WHEN docs = 1 AND coverage >= 0.8 THEN 'direct_copy_candidate' WHEN docs <= 3 THEN 'small_compile' WHEN docs <= 20 THEN 'compile' ELSE 'chunked_compile' END AS strategy FROM p)
"""


def _plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("docs"), (F.max("o_totalprice") / F.sum("o_totalprice")).alias("coverage"), F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent")
    )
    plans = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    plans = plans.select(
        "c_custkey", "c_mktsegment", F.coalesce("docs", F.lit(0)).alias("docs"), (F.col("c_acctbal") >= 0).alias("candidate"),
        F.coalesce("urgent", F.lit(False)).alias("review"), F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )
    return plans.withColumn("strategy", planning.strategy(F.col("docs"), F.col("candidate"), F.col("review"), F.col("coverage")))


@REGISTRY.query(f"WITH {SQL_PLANS} SELECT c_custkey, docs, strategy FROM s")
def cls_strategy_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans(spark, sf_dir).select("c_custkey", "docs", "strategy")


@REGISTRY.query(f"""
    WITH {SQL_PLANS} SELECT c_mktsegment, strategy, count(*) AS plans_count, sum(docs) AS documents_sum, count(*) FILTER (WHERE review) AS review_count FROM s GROUP BY ALL
""")
def agg_strategy_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plans(spark, sf_dir).groupBy("c_mktsegment", "strategy").agg(
        F.count("*").alias("plans_count"), F.sum("docs").alias("documents_sum"), F.count_if("review").alias("review_count")
    )


@REGISTRY.query(f"""
    WITH {SQL_PLANS} SELECT c_custkey, strategy, CASE WHEN strategy = 'review_stub' AND c_mktsegment <> 'MACHINERY' AND docs > 0
        THEN CASE WHEN docs <= 3 THEN 'small_compile' WHEN docs <= 20 THEN 'compile' ELSE 'chunked_compile' END ELSE strategy END AS repaired FROM s
""")
def cls_plan_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = planning.repaired(F.col("strategy"), F.col("docs"), F.col("c_mktsegment") == "MACHINERY")
    return _plans(spark, sf_dir).select("c_custkey", "strategy", again.alias("repaired"))


@REGISTRY.query("""
    SELECT o_orderkey, l_linenumber, l_partkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'high' WHEN l_quantity >= 25 THEN 'normal' ELSE 'low' END AS priority,
        CASE WHEN l_quantity >= 40 THEN 4096 WHEN l_quantity >= 15 THEN 2048 ELSE 1024 END AS output_tokens
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O'
""")
def jn_task_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans = table(spark, sf_dir, "orders").filter("o_orderstatus = 'O'")
    tasks = planning.task_queue(plans, "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey")
    urgent, size = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("l_quantity")
    return tasks.select(
        "o_orderkey", "l_linenumber", "l_partkey",
        F.when(urgent, "high").when(size >= 25, "normal").otherwise("low").alias("priority"),
        F.when(size >= 40, 4096).when(size >= 15, 2048).otherwise(1024).alias("output_tokens"),
    )


@REGISTRY.query("""
    WITH RECURSIVE d AS (SELECT source, doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
    f AS (
        SELECT source, doc_id, k, 0 AS batch, 1 AS rows_in, n_chars AS total FROM d WHERE k = 1
        UNION ALL SELECT d.source, d.doc_id, d.k,
            CASE WHEN f.rows_in >= 5 OR f.total + d.n_chars > 50000 THEN f.batch + 1 ELSE f.batch END,
            CASE WHEN f.rows_in >= 5 OR f.total + d.n_chars > 50000 THEN 1 ELSE f.rows_in + 1 END,
            CASE WHEN f.rows_in >= 5 OR f.total + d.n_chars > 50000 THEN d.n_chars ELSE f.total + d.n_chars END
        FROM f JOIN d ON f.source = d.source AND d.k = f.k + 1
    ) SELECT source, doc_id, batch FROM f
""")
def grf_bin_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.bin_fill(table(spark, sf_dir, "documents"), "source", "doc_id", "n_chars", 5, 50000)


@REGISTRY.query("""
    WITH d AS (SELECT d.doc_id, d.text, d.n_chars, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
    r AS (SELECT doc_id,
        list_filter([CASE WHEN n_chars < 20 THEN 'too_short' END, CASE WHEN toxic = 1 THEN 'toxic' END], lambda x: x IS NOT NULL) AS no,
        list_filter([CASE WHEN quality = 0 THEN 'low_quality' END, CASE WHEN n_chars > 20000 THEN 'too_long' END, CASE WHEN quality IS NULL THEN 'unlabelled' END], lambda x: x IS NOT NULL) AS maybe FROM d)
    SELECT doc_id, CASE WHEN len(no) > 0 THEN 'rejected' WHEN len(maybe) > 0 THEN 'review' ELSE 'valid' END AS layer,
        array_to_string(list_sort(list_concat(no, maybe)), ',') AS reasons FROM r
""")
def cls_evidence_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    layer, reasons = evidence.evidence_layer(
        {"too_short": F.col("n_chars") < 20, "toxic": F.col("toxic") == 1},
        {"low_quality": F.col("quality") == 0, "too_long": F.col("n_chars") > 20000, "unlabelled": F.col("quality").isNull()},
    )
    return docs.select("doc_id", layer.alias("layer"), F.array_join(reasons, ",").alias("reasons"))


@REGISTRY.query(f"""
    WITH l AS (SELECT lang, source, doc_id, {SQL_KEY.format("unnest(string_split(coalesce(text, ''), chr(10)))")} AS claim FROM documents)
    SELECT lang, source, sha256(claim) AS claim_sha256, min(doc_id) AS doc_id, count(*) AS duplicates FROM l WHERE claim <> '' GROUP BY ALL
""")
def win_evidence_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as claims: the first document of each."""
    lines = table(spark, sf_dir, "documents").select("lang", "source", "doc_id", F.explode(F.split(T.text_or_empty(F.col("text")), "\n")).alias("line"))
    claims = lines.withColumn("claim", T.match_key(F.col("line"))).filter("claim <> ''").withColumn("claim_sha256", F.sha2("claim", 256))
    return evidence.first_of_equals(claims, ["lang", "source", "claim_sha256"], "doc_id")


@REGISTRY.query()
def grf_fact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as claims of the tag that their language and first words make, with their last sentence as
    quote; tests compare the operator with a fold over all claims."""
    lines = table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.split(T.text_or_empty(F.col("text")), "\n")).alias("k", "line")).filter("trim(line) <> ''")
    word, between = T.WORD, r"[^\p{L}\p{N}_]+"
    first = lambda n: F.regexp_extract(F.lower("line"), f"^(?:{between})?" + f"{word}{between}" * n + f"({word})", 1)
    sentences = F.filter(F.split("line", r"[.!?]+"), lambda s: F.trim(s) != "")
    claims = lines.select(
        F.concat_ws("/", "lang", first(0), F.nullif(first(1), F.lit(""))).alias("tag"), F.when(F.length("line") <= 60, "short").otherwise("long").alias("kind"),
        F.concat_ws(":", "doc_id", "k").alias("id"), F.col("line").alias("claim"), F.when(F.size(sentences) > 1, F.element_at(sentences, -1)).alias("quote"), "doc_id",
    )
    return facts.fact_groups(claims, "tag", "kind", "id", "claim", "quote", "doc_id")


@REGISTRY.query("""
    SELECT source, count(*) FILTER (WHERE quality = 1) AS good_count, count(*) FILTER (WHERE quality = 0) AS poor_count, count(*) FILTER (WHERE toxic = 1) AS toxic_count
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source
""")
def jn_tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labelled = docs.join(table(spark, sf_dir, "labels"), "doc_id")
    parts = {"good": labelled.filter("quality = 1"), "poor": labelled.filter("quality = 0"), "toxic": labelled.filter("toxic = 1")}
    return evidence.coverage(docs, "source", parts)


@REGISTRY.query("""
    WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER w AS rank,
        coalesce(sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber))
    SELECT l_suppkey, l_orderkey, l_linenumber, rank FROM r WHERE rank = 1 OR (rank <= 80 AND before < 1200)
""")
def top_ranked_soft_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem")
    found = windows.ranked_soft_cap(items, "l_suppkey", ["l_shipdate", "l_orderkey", "l_linenumber"], "l_quantity", 80, 1200)
    return found.select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@REGISTRY.query("SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS turn FROM customer")
def top_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return windows.round_robin(customers, "c_mktsegment", [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_custkey", "c_mktsegment", "turn")


@REGISTRY.query("""
    SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY (c_acctbal < 0)::INT DESC, sha256(CAST(c_custkey AS VARCHAR))) AS sample_rank
    FROM customer QUALIFY sample_rank <= 25
""")
def top_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = windows.stratified_sample(table(spark, sf_dir, "customer"), "c_mktsegment", "c_custkey", F.col("c_acctbal") < 0, 25)
    return found.select("c_custkey", "c_mktsegment", "sample_rank")


@REGISTRY.query("""
    SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'compiled' WHEN l.doc_id IS NOT NULL THEN 'entity' WHEN length(d.text) >= 1000 THEN 'insufficient' ELSE 'missing' END AS article_source
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def cls_source_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    sources = [("compiled", F.col("quality") == 1), ("entity", F.col("quality").isNotNull()), ("insufficient", F.length("text") >= 1000)]
    return docs.select("doc_id", planning.first_source(sources).alias("article_source"))


@REGISTRY.query(r"""
    WITH b AS (SELECT p_partkey, regexp_replace(regexp_replace(p_brand || ' ' || p_name, '[^\p{L}\p{N}_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS base FROM part)
    SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY p_partkey) = 1 THEN base ELSE base || '_' || p_partkey END AS file_name FROM b
""")
def win_unique_filenames(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "part").withColumn("base", T.safe_filename(F.concat_ws(" ", "p_brand", "p_name")))
    return windows.unique_names(named, "base", "p_partkey").select("p_partkey", "file_name")


@REGISTRY.query("SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1 AS active FROM events")
def udf_latest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return windows.latest(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]).select("event_id", "user_id", "event_type", "active")


@REGISTRY.query("""
    SELECT doc_id, sha256(text) AS request_key FROM documents d
    WHERE NOT EXISTS (SELECT 1 FROM documents p JOIN labels l ON p.doc_id = l.doc_id WHERE sha256(p.text) = sha256(d.text))
""")
def udf_resume_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("request_key"))
    done = requests.join(table(spark, sf_dir, "labels"), "doc_id", "left_semi")
    return external.resumed(requests, done, "request_key").select("doc_id", "request_key")


@REGISTRY.query("""
    WITH c AS (SELECT source, doc_id, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens FROM documents),
    r AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY doc_id) AS running_cost FROM c)
    SELECT source, doc_id, tokens, running_cost FROM r WHERE running_cost <= 20000
""")
def udf_budget_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    costs = table(spark, sf_dir, "documents").select("source", "doc_id", T.estimated_tokens(F.col("text")).alias("tokens"))
    return windows.within_budget(costs, "source", ["doc_id"], "tokens", 20000)


@REGISTRY.query()
def udf_stub_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities of whole texts: a request per window, a surface once per document where it comes first."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(T.prompt_windows(F.col("text"), 4000)).alias("window", "text"))
    requests = docs.select("doc_id", "window", external.request_of(F.col("text"), "v1").alias("request"))
    found = external.entities(external.call(requests, "request", external.stub_model), "response").filter("size(errors) = 0")
    found = found.select("doc_id", "window", external.cache_key(F.col("request")).alias("request_key"), F.posexplode("entities").alias("at", "e"))
    first = F.min(F.struct("window", "at", "request_key", "e.role", "e.confidence")).alias("first")
    found = found.groupBy("doc_id", F.col("e.surface").alias("surface")).agg(first)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("first.window", "first.at")) - 1
    return found.select("doc_id", "first.request_key", place.alias("entity_index"), "surface", "first.role", "first.confidence")


@REGISTRY.query("""
    SELECT count(*) AS documents_count, count(DISTINCT d.doc_id) = count(*) AS ids_unique, count(l.doc_id) AS labelled_count,
        count(*) FILTER (WHERE text IS NULL OR text = '') AS empty_count, bool_and(n_chars = length(text)) AS lengths_match,
        count(*) FILTER (WHERE quality NOT IN (0, 1) OR toxic NOT IN (0, 1)) = 0 AS labels_valid
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def qa_stage_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return docs.agg(
        F.count("*").alias("documents_count"),
        (F.countDistinct("doc_id") == F.count("*")).alias("ids_unique"),
        F.count("quality").alias("labelled_count"),
        F.count_if(F.col("text").isNull() | (F.col("text") == "")).alias("empty_count"),
        F.bool_and(F.col("n_chars") == F.length("text")).alias("lengths_match"),
        (F.count_if(~F.col("quality").isin(0, 1) | ~F.col("toxic").isin(0, 1)) == 0).alias("labels_valid"),
    )


@REGISTRY.query("""
    WITH w AS (SELECT CASE WHEN length(text) >= 1000 THEN 'high' WHEN length(text) >= 300 THEN 'medium' ELSE 'low' END AS quality, role AS method, conv_id, length(text) AS n FROM conversations)
    SELECT method, quality, count(*) AS windows_count, count(DISTINCT conv_id) AS documents_count, round(avg(n), 2) AS characters_avg FROM w GROUP BY ALL
""")
def agg_window_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.length("text")
    quality = F.when(n >= 1000, "high").when(n >= 300, "medium").otherwise("low").alias("quality")
    turns = table(spark, sf_dir, "conversations").select(F.col("role").alias("method"), quality, "conv_id", n.alias("n"))
    return turns.groupBy("method", "quality").agg(
        F.count("*").alias("windows_count"), F.countDistinct("conv_id").alias("documents_count"), F.round(F.avg("n"), 2).alias("characters_avg")
    )


@REGISTRY.query("""
    SELECT field, value, count(*) AS rows_count, count(DISTINCT p_partkey) AS parts_count
    FROM (UNPIVOT (SELECT p_partkey, p_name, p_brand, p_type FROM part) ON p_name, p_brand, p_type INTO NAME field VALUE value)
    GROUP BY ALL HAVING count(*) >= 5
""")
def qa_unpivot_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    long = parts.unpivot("p_partkey", ["p_name", "p_brand", "p_type"], "field", "value").filter("value is not null")
    return long.groupBy("field", "value").agg(F.count("*").alias("rows_count"), F.countDistinct("p_partkey").alias("parts_count")).filter("rows_count >= 5")


@REGISTRY.query("""
    WITH o AS (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag || l_linestatus)) AS labels FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, array_to_string(labels, ',') AS labels, list_has_all(labels, ['AF', 'RF']) AS bad_mix, len(list_filter(['AF', 'RF', 'NO'], lambda x: NOT list_contains(labels, x))) AS uncovered FROM o
""")
def set_known_bad_subsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").withColumn("label", F.concat("l_returnflag", "l_linestatus"))
    orders = items.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    missing = lambda *wanted: F.size(F.array_except(F.array(*map(F.lit, wanted)), F.col("labels")))
    return orders.select(
        "l_orderkey", F.array_join("labels", ",").alias("labels"), (missing("AF", "RF") == 0).alias("bad_mix"), missing("AF", "RF", "NO").alias("uncovered")
    )


@REGISTRY.query("""
    SELECT value, rows_count FROM (SELECT user_id AS value, count(*) AS rows_count FROM events WHERE event_type <> 'view' GROUP BY user_id HAVING count(*) >= 2)
    ORDER BY rows_count DESC, value LIMIT 50
""")
def top_counter_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "events").filter("event_type <> 'view'").groupBy(F.col("user_id").alias("value")).agg(F.count("*").alias("rows_count"))
    return counts.filter("rows_count >= 2").orderBy(F.col("rows_count").desc(), "value").limit(50)


@REGISTRY.query("""
    SELECT (SELECT count(*) FROM labels) AS labels_count, (SELECT count(*) FROM labels l ANTI JOIN documents d ON d.doc_id = l.doc_id) AS only_labels,
        (SELECT count(*) FROM documents d ANTI JOIN labels l ON d.doc_id = l.doc_id) AS only_documents,
        (SELECT count(*) FROM (SELECT doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1)) AS repeated_labels
""")
def jn_set_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id").distinct().withColumn("d", F.lit(1))
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.count("*").alias("l"))
    both = docs.join(labels, "doc_id", "full")
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("labels_count"),
        F.count_if(F.col("d").isNull()).alias("only_labels"),
        F.count_if(F.col("l").isNull()).alias("only_documents"),
        F.count_if(F.col("l") > 1).alias("repeated_labels"),
    )


@REGISTRY.query("""
    WITH m AS (SELECT c_nationkey AS tag, c_mktsegment AS role, c_custkey, c_acctbal FROM customer), n AS (SELECT tag, role, count(*) AS n FROM m GROUP BY ALL)
    SELECT tag, count(*) AS mentions_count, round(avg(c_acctbal), 6) AS balance_avg, bool_or(c_acctbal < 0) AS any_debt, bool_and(c_acctbal > -900) AS all_sound,
        (SELECT role FROM n WHERE n.tag = m.tag ORDER BY n DESC, role LIMIT 1) AS primary_role FROM m GROUP BY tag
""")
def agg_component_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("tag"), F.col("c_mktsegment").alias("role"), "c_acctbal")
    roles = mentions.groupBy("tag", "role").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("s"), F.min("c_acctbal").alias("least"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "role"))["role"]
    return roles.groupBy("tag").agg(
        F.sum("n").alias("mentions_count"), F.round(F.sum("s") / F.sum("n"), 6).alias("balance_avg"), F.bool_or(F.col("least") < 0).alias("any_debt"),
        F.bool_and(F.col("least") > -900).alias("all_sound"), first.alias("primary_role"),
    )


@REGISTRY.query("""
    SELECT count(*) AS tasks_count, sum(l_quantity) AS tokens_sum, round(sum(l_extendedprice) / count(*), 6) AS cost_per_task,
        round(sum(l_extendedprice) / nullif(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END), 0), 6) AS cost_per_accepted, round(avg(l_tax), 6) AS latency_avg FROM lineitem
""")
def agg_cost_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, cost = table(spark, sf_dir, "lineitem"), F.sum("l_extendedprice")
    return items.agg(
        F.count("*").alias("tasks_count"), F.sum("l_quantity").alias("tokens_sum"), F.round(cost / F.count("*"), 6).alias("cost_per_task"),
        F.round(cost / F.nullif(F.count_if(F.col("l_returnflag") == "A"), F.lit(0)), 6).alias("cost_per_accepted"), F.round(F.avg("l_tax"), 6).alias("latency_avg"),
    )


@REGISTRY.query("""
    WITH t AS (SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns, string_agg(role, '>' ORDER BY turn) AS roles, sum(length(text)) AS characters FROM conversations GROUP BY conv_id)
    SELECT *, CASE WHEN first_turn <> 0 THEN 'starts_late' WHEN last_turn + 1 <> turns THEN 'has_gaps' WHEN NOT starts_with(roles, 'user') THEN 'wrong_start' ELSE 'ok' END AS status FROM t
""")
def gen_conversation_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role")))
    windows_ = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count("*").alias("turns"),
        F.array_join(F.transform(turns, lambda t: t["role"]), ">").alias("roles"), F.sum(F.length("text")).alias("characters"),
    )
    status = F.when(F.col("first_turn") != 0, "starts_late").when(F.col("last_turn") + 1 != F.col("turns"), "has_gaps").when(~F.col("roles").startswith("user"), "wrong_start")
    return windows_.withColumn("status", status.otherwise("ok"))


@REGISTRY.query("""
    WITH r AS (SELECT o_custkey AS rid, c_nationkey AS component, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey),
    p AS (SELECT component, rid, count(*) AS members, min(o_orderkey) AS first_member FROM r GROUP BY ALL HAVING count(*) > 1)
    SELECT component, count(*) AS rejected_groups, sum(members) AS members_count, min(first_member) AS first_member FROM p GROUP BY component
""")
def grf_rejected_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected groups of which several members lie in one component."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    shared = orders.groupBy(F.col("c_nationkey").alias("component"), "o_custkey").agg(F.count("*").alias("members"), F.min("o_orderkey").alias("first_member"))
    return shared.filter("members > 1").groupBy("component").agg(
        F.count("*").alias("rejected_groups"), F.sum("members").alias("members_count"), F.min("first_member").alias("first_member")
    )


@REGISTRY.query("""
    WITH b AS (SELECT l_orderkey AS batch, l_linenumber AS task, count(*) OVER (PARTITION BY l_orderkey) AS n, bool_or(l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS failed,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS k FROM lineitem)
    SELECT batch, task, k AS place, CASE WHEN failed AND n > 1 THEN batch || CASE WHEN k <= (n + 1) // 2 THEN '_s1' ELSE '_s2' END ELSE CAST(batch AS VARCHAR) END AS batch_id FROM b
""")
def udf_split_failed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that failed are halved for the next round."""
    items = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("task"), "l_partkey", "l_suppkey", (F.col("l_returnflag") == "R").alias("failed")
    )
    return external.halved(items, "batch", ["task", "l_partkey", "l_suppkey"], "failed").select("batch", "task", "place", "batch_id")


@REGISTRY.query("""
    WITH r AS (SELECT l_orderkey, count(*) AS results, count(DISTINCT l_linenumber) AS tasks, bool_or(l_quantity > 49) AS oversized FROM lineitem GROUP BY l_orderkey)
    SELECT coalesce(o_orderkey, l_orderkey) AS task_id, array_to_string(list_filter([CASE WHEN results > tasks THEN 'duplicate_results' END, CASE WHEN r.l_orderkey IS NULL THEN 'missing_result' END,
        CASE WHEN oversized THEN 'over_limit' END, CASE WHEN o_orderkey IS NULL THEN 'unknown_task' END], lambda x: x IS NOT NULL), ',') AS errors
    FROM orders FULL JOIN r ON o_orderkey = l_orderkey
""")
def cls_response_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested and answered tasks against each other."""
    items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("results"), F.countDistinct("l_linenumber").alias("tasks"), F.bool_or(F.col("l_quantity") > 49).alias("oversized")
    )
    both = table(spark, sf_dir, "orders").select("o_orderkey").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    errors = T.flags(
        duplicate_results=F.col("results") > F.col("tasks"), missing_result=F.col("l_orderkey").isNull(), over_limit=F.col("oversized"), unknown_task=F.col("o_orderkey").isNull()
    )
    return both.select(F.coalesce("o_orderkey", "l_orderkey").alias("task_id"), F.array_join(errors, ",").alias("errors"))


@REGISTRY.query("""
    SELECT p_partkey, upper(array_to_string(list_transform(list_filter(regexp_extract_all(lower(p_name || ' ' || p_type), '[\\p{L}\\p{N}_]+'), lambda t: t NOT IN ('and', 'of', 'the')), lambda t: t[1]), '')) AS acronym,
        array_to_string(list_transform(regexp_extract_all(p_name || ' (' || p_brand || ') (' || p_type || ')', '\\(([^)]*)\\)', 1), lambda x: lower(x)), '|') AS parenthetical
    FROM part
""".replace("\\\\", "\\"))
def txt_label_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Initials of the words but for short function words, and what stands in parentheses."""
    label = F.concat_ws(" ", "p_name", "p_type")
    inside = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(") ("), "p_type", F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", T.acronym(label).alias("acronym"), F.array_join(T.parenthetical(inside), "|").alias("parenthetical"))


@REGISTRY.query("""
    SELECT doc_id, CASE WHEN length(text) <= 400 THEN length(text) ELSE 400 + 7 END AS prompt_length, CAST(ceil(length(text) / 4.0) AS BIGINT) AS tokens_estimate,
        round(CAST(ceil(length(text) / 4.0) AS BIGINT) * 0.15 / 1000000, 8) AS cost_usd,
        sha256(CASE WHEN length(text) <= 400 THEN text ELSE left(text, 200) || chr(10) || '[...]' || chr(10) || right(text, 200) END) AS prompt_sha256 FROM documents
""")
def txt_prompt_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts that keep the two ends of long texts, with estimated tokens and cost."""
    prompt = T.head_and_tail(F.col("text"), 400)
    tokens = T.estimated_tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(prompt).alias("prompt_length"), tokens.alias("tokens_estimate"), external.cost(tokens, 0.15).alias("cost_usd"), F.sha2(prompt, 256).alias("prompt_sha256")
    )


@REGISTRY.query("""
    WITH g AS (SELECT source, count(*) FILTER (WHERE quality = 1) AS usable, count(*) AS every, coalesce(bool_or(toxic = 1), FALSE) AS review FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source)
    SELECT source, usable, CASE WHEN usable = 0 THEN 'insufficient' WHEN usable <= 3 THEN 'short_article' WHEN review THEN 'reviewed_article' ELSE 'full_article' END AS strategy,
        round(usable / every, 6) AS coverage FROM g
""")
def cls_article_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    found = docs.groupBy("source").agg(F.count_if(F.col("quality") == 1).alias("usable"), F.count("*").alias("every"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("review"))
    strategy = F.when(F.col("usable") == 0, "insufficient").when(F.col("usable") <= 3, "short_article").when(F.col("review"), "reviewed_article").otherwise("full_article")
    return found.select("source", "usable", strategy.alias("strategy"), F.round(F.col("usable") / F.col("every"), 6).alias("coverage"))


@REGISTRY.query("""
    SELECT conv_id, string_agg(CASE WHEN role = 'user' THEN '{"type":"header","text":"' ELSE '{"type":"paragraph","text":"' END || length(text) || '"}', ',' ORDER BY turn) AS blocks FROM conversations GROUP BY conv_id
""")
def gen_source_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rows as blocks of one document."""
    block = F.to_json(F.struct(F.when(F.col("role") == "user", "header").otherwise("paragraph").alias("type"), F.length("text").cast("string").alias("text")))
    ordered = F.array_sort(F.collect_list(F.struct("turn", block.alias("block"))))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(ordered, lambda b: b["block"]), ",").alias("blocks"))
