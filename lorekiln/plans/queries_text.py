"""Sources, blocks, text functions and aggregations."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.functions.batches import small_batches
from lorekiln.operators import blocks, clusters, rich_text
from lorekiln.operators.quotes import small
from lorekiln.plans.registry import Registry, table
from lorekiln.plans.sql_text import sql_basic

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql

#: SQL of the native text functions.
SQL_KEY = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}_]+', ' ', 'g'))"
SQL_TOKENS = r"list_sort(list_distinct(regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}_]+')))"
SQL_LINES = """
    lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
            generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS block_index
        FROM documents
    ), blocks AS (
        SELECT doc_id, block_index, 'b_' || lpad(CAST(block_index + 1 AS VARCHAR), 6, '0') AS block_id,
            CASE WHEN trim(line) = '' THEN 'empty' WHEN starts_with(trim(line), '- ') THEN 'list'
                WHEN length(trim(line)) <= 60 AND NOT regexp_matches(trim(line), '[.,:;!?]$') THEN 'header'
                ELSE 'paragraph' END AS block_type,
            trim(line) AS text, length(trim(line)) AS text_length,
            CASE WHEN trim(line) = '' THEN 'empty_or_unhandled_block' ELSE 'ok' END AS parse_status
        FROM lines
    )
"""


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels by distinct documents: blocks, words, keys, counts, the 100 most frequent."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.split(T.text_or_empty(F.col("text")), "\n").alias("lines"))
    docs = docs.select("doc_id", F.transform("lines", lambda x: F.array_distinct(F.regexp_extract_all(F.lower(x), F.lit(T.WORD), F.lit(0)))).alias("words"))
    ids = table(spark, sf_dir, "documents").select("doc_id")
    repeated = small(ids.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id"))
    # A document of one row counts its words alone: only sums of labels are shuffled.
    alone = docs.join(repeated, "doc_id", "left_anti").withColumn("words", F.flatten("words"))
    once = F.when(F.col("doc_id").isNotNull(), F.array_distinct("words")).otherwise(F.array().cast("array<string>"))
    named = lambda words, d, b: F.struct(words.alias("words"), F.lit(d).cast("long").alias("d"), F.lit(b).cast("long").alias("b"))
    rows = alone.select(F.inline(F.array(named(once, 1, 0), named(F.col("words"), 0, 1)))).select(F.explode("words").alias("label"), "d", "b")
    several = docs.join(repeated, "doc_id", "left_semi").select("doc_id", F.explode(F.flatten("words")).alias("label"))
    several = several.groupBy("label").agg(F.countDistinct("doc_id").alias("d"), F.count("*").alias("b"))
    counts = rows.unionByName(several).groupBy("label").agg(F.sum("d").alias("documents_count"), F.sum("b").alias("blocks_count"))
    return counts.orderBy(F.col("documents_count").desc(), "label").limit(100)


@REGISTRY.query(f"""
    WITH {SQL_LINES}, words AS (SELECT doc_id, unnest({SQL_TOKENS.format('text')}) AS label FROM blocks)
    SELECT label, count(DISTINCT doc_id) AS documents_count, count(*) AS blocks_count FROM words
    GROUP BY label ORDER BY documents_count DESC, label LIMIT 100
""")
def top_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagship(spark, sf_dir)


@REGISTRY.query("""
    SELECT 'doc_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '_' || substr(sha256(text), 1, 8) AS source_id,
        sha256(text) AS content_hash, CASE WHEN trim(text) = '' THEN 'empty' ELSE 'ok' END AS parse_status,
        length(text) AS text_length
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
""")
def src_documents_scan_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("doc_id is not null and text is not null")
    return docs.select(
        blocks.source_id(F.col("doc_id"), F.col("text")).alias("source_id"),
        F.sha2("text", 256).alias("content_hash"),
        F.when(F.trim("text") == "", "empty").otherwise("ok").alias("parse_status"),
        F.length("text").alias("text_length"),
    )


@REGISTRY.query(f"WITH {SQL_LINES} SELECT doc_id, block_index, block_id, block_type, text_length, parse_status, sha256(text) AS text_sha256 FROM blocks")
def gen_document_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocks.line_blocks(table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.sha2("text", 256)).drop("text")


@REGISTRY.query(f"""
    WITH {SQL_LINES} SELECT block_type, parse_status, count(*) AS blocks_count, count(DISTINCT doc_id) AS documents_count,
        sum(text_length) AS characters FROM blocks GROUP BY ALL
""")
def gen_block_type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blocks.line_blocks(table(spark, sf_dir, "documents"))
    return found.groupBy("block_type", "parse_status").agg(
        F.count("*").alias("blocks_count"), F.countDistinct("doc_id").alias("documents_count"), F.sum("text_length").alias("characters")
    )


@REGISTRY.query(r"""
    SELECT page_id, sha256(t) AS text_sha256, length(t) AS text_length FROM (
        SELECT page_id, trim(regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS t FROM pages)
""")
def gen_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", T.strip_tags(F.col("html")).alias("t"))
    return pages.select("page_id", F.sha2("t", 256).alias("text_sha256"), F.length("t").alias("text_length"))


@REGISTRY.query()
def gen_page_blocks_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", F.posexplode(T.html_blocks(F.col("html"))).alias("block_index", "b"))
    return pages.select("page_id", "block_index", F.col("b.kind").alias("block_type"), F.col("b.text").alias("text"))


#: Lines of documents as blocks of all types in turn, without what would be markup in them.
BLOCK_TYPES = ("paragraph", "header", "list", "quote", "table", "checklist", "delimiter", "code", "warning", "image", "custom")


def rich_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, content): each line of a document is a block; its type goes by its place."""
    line = lambda t: F.translate(t, "<>&", "   ")
    parts = lambda t: F.split(line(t), ", ")
    data = {
        "paragraph": lambda t: F.struct(F.concat(F.lit("<b>"), line(t), F.lit("</b>")).alias("text")),
        "header": lambda t: F.struct(line(t).alias("text"), F.lit(2).alias("level")),
        "list": lambda t: F.struct(F.transform(parts(t), lambda p: F.struct(p.alias("content"), F.array(F.struct(F.concat(F.lit("<i>in</i> "), p).alias("text"))).alias("items"))).alias("items")),
        "quote": lambda t: F.struct(line(t).alias("text"), F.lit("said &amp; done").alias("caption")),
        "table": lambda t: F.struct(F.transform(parts(t), lambda p: F.split(p, " ")).alias("content")),
        "checklist": lambda t: F.struct(F.transform(parts(t), lambda p, k: F.struct(p.alias("text"), (k % 2 == 0).alias("checked"))).alias("items")),
        "delimiter": lambda t: F.struct(F.lit(1).alias("width")),
        "code": lambda t: F.struct(F.concat(line(t), F.lit(" a<b>")).alias("code")),
        "warning": lambda t: F.struct(F.lit("Note").alias("title"), line(t).alias("message")),
        "image": lambda t: F.struct(F.lit("").alias("caption"), F.lit("here").alias("source")),
        "custom": lambda t: F.struct(F.struct(line(t).alias("title"), F.array(line(t), F.lit("other")).alias("items"), F.lit("no").alias("else")).alias("content")),
    }
    lines = F.split(T.text_or_empty(F.col("text")), "\n")

    def block(text: Column, k: Column) -> Column:
        made = F.lit(None).cast("string")
        for place, name in enumerate(BLOCK_TYPES):
            made = F.when(k % len(BLOCK_TYPES) == place, F.to_json(F.struct(F.lit(name).alias("type"), data[name](text).alias("data")))).otherwise(made)
        return made

    made = F.concat(F.lit('{"blocks":['), F.array_join(F.transform(lines, block), ","), F.lit("]}"))
    return table(spark, sf_dir, "documents").select("doc_id", made.alias("content"))


SQL_RICH = r"""
    l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS k FROM documents),
    t AS (SELECT doc_id, k, translate(line, '<>&', '   ') AS t, string_split(translate(line, '<>&', '   '), ', ') AS p FROM l),
    x AS (
        SELECT doc_id, k, CASE k % 11 WHEN 6 THEN '' WHEN 9 THEN ''
            WHEN 0 THEN C(t) WHEN 1 THEN C(t) WHEN 3 THEN concat_ws(chr(10), nullif(C(t), ''), 'said & done') WHEN 7 THEN C(t || ' a<b>') WHEN 8 THEN concat_ws(chr(10), 'Note', nullif(C(t), ''))
            WHEN 2 THEN array_to_string(list_transform(p, lambda i: CASE WHEN C(i) = '' THEN '' ELSE '- ' || C(i) || chr(10) END || '  - ' || C('in ' || i)), chr(10))
            WHEN 4 THEN array_to_string(list_filter(list_transform(p, lambda i: array_to_string(list_filter(list_transform(string_split(i, ' '), lambda c: C(c)), lambda c: c <> ''), chr(9))), lambda r: r <> ''), chr(10))
            WHEN 5 THEN array_to_string(list_filter(list_transform(p, lambda i, n: CASE WHEN C(i) = '' THEN '' WHEN n % 2 = 1 THEN '[x] ' || C(i) ELSE '[ ] ' || C(i) END), lambda r: r <> ''), chr(10))
            ELSE CASE WHEN C(t) IN ('', 'other') THEN 'other' ELSE C(t) || chr(10) || 'other' END END AS text
        FROM t
    ), b AS (SELECT doc_id, k, trim(text) AS text, CASE WHEN trim(text) <> '' OR k % 11 IN (6, 9) THEN 'ok' ELSE 'empty_or_unhandled_block' END AS status FROM x)
"""
SQL_RICH = re.sub(r"\bC\(('in ' \|\| i|t \|\| ' a<b>'|[a-z])\)", r"trim(regexp_replace(\1, '[ \\t\\r\\f\\x0B]+', ' ', 'g'))", SQL_RICH)


@REGISTRY.query(f"""
    WITH {SQL_RICH}, d AS (SELECT doc_id, count(*) AS blocks_count, count(*) FILTER (WHERE status = 'ok') AS sound_blocks_count,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY k) FILTER (WHERE text <> ''), '') AS clean FROM b GROUP BY doc_id)
    SELECT doc_id, CASE WHEN clean = '' THEN 'empty' WHEN sound_blocks_count < blocks_count THEN 'partial' ELSE 'ok' END AS parse_status,
        blocks_count - sound_blocks_count AS errors_count, blocks_count, sound_blocks_count, sha256(clean) AS clean_sha256 FROM d
""")
def gen_rich_text_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of blocks of all types, as text."""
    small_batches(spark)
    found = rich_documents(spark, sf_dir).select("doc_id", rich_text.parsed(F.col("content")).alias("p"))
    return found.select(
        "doc_id", "p.parse_status", F.size("p.parse_errors").alias("errors_count"), F.size("p.blocks").alias("blocks_count"),
        F.size(F.filter("p.blocks", lambda b: b["parse_status"] == "ok")).alias("sound_blocks_count"), F.sha2("p.clean_text", 256).alias("clean_sha256"),
    )


@REGISTRY.query(f"""
    WITH {SQL_RICH} SELECT k % 11 AS type_number, status AS parse_status, count(*) AS blocks_count, sum(length(text)) AS characters FROM b GROUP BY ALL
""")
def gen_rich_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blocks of all documents by type and status."""
    rows = rich_text.block_rows(rich_documents(spark, sf_dir), "doc_id", "content")
    number = F.array_position(F.array(*map(F.lit, BLOCK_TYPES)), F.col("block_type")) - 1
    return rows.groupBy(number.alias("type_number"), "parse_status").agg(F.count("*").alias("blocks_count"), F.sum("text_length").alias("characters"))


@REGISTRY.query("""
    SELECT 'duplicate_id' AS violation, CAST(doc_id AS VARCHAR) AS key FROM documents GROUP BY doc_id HAVING count(*) > 1
    UNION ALL SELECT 'orphan_child', CAST(doc_id AS VARCHAR) FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
    UNION ALL SELECT 'missing_child', CAST(doc_id AS VARCHAR) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE d.doc_id = l.doc_id)
    UNION ALL SELECT 'length_mismatch', CAST(doc_id AS VARCHAR) FROM documents WHERE n_chars <> length(text)
""")
def val_parsed_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return blocks.integrity_violations(docs, labels, "doc_id", "doc_id", "n_chars", "text")


@REGISTRY.query(f"""
    SELECT 'document' AS kind, doc_id AS id, sha256({sql_basic('text')}) AS key_sha256 FROM documents
    UNION ALL SELECT 'part', p_partkey, sha256({sql_basic("p_name || ' / ' || p_brand || '.'")}) FROM part
""")
def txt_normalize_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("t"))
    parts = table(spark, sf_dir, "part").select(F.lit("part"), "p_partkey", F.concat("p_name", F.lit(" / "), "p_brand", F.lit(".")))
    return docs.union(parts).select("kind", "id", F.sha2(T.normalize_basic(F.col("t")), 256).alias("key_sha256"))


@REGISTRY.query()
def txt_normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.sha2(T.normalize_label(F.col("html")), 256).alias("key_sha256"))


SQL_PROTECTED = " OR ".join(f"regexp_matches({{0}}, '(?i){p}')" for p in T.PROTECTED_NUMBERS)
SQL_STEM = r"regexp_replace(regexp_extract({0}, '^(.+?)\s+(\d+[a-zа-я]?)$', 1), '^[ -]+|[ -]+$', '', 'g')"


@REGISTRY.query(f"""
    WITH n AS (SELECT replace(x, '#', ' ') AS x FROM (SELECT s_name AS x FROM supplier UNION ALL SELECT c_name FROM customer UNION ALL SELECT p_brand FROM part)),
    k AS (SELECT {sql_basic('x')} AS k FROM n), v AS (SELECT k, {SQL_STEM.format('k')} AS stem FROM k)
    SELECT CASE WHEN stem = '' OR {SQL_PROTECTED.format('k')} OR {SQL_PROTECTED.format('stem')} THEN k ELSE stem END AS name_key, count(*) AS rows_count FROM v GROUP BY ALL
""")
def txt_strip_numeric_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("x"))
    names = names.union(table(spark, sf_dir, "customer").select("c_name")).union(table(spark, sf_dir, "part").select("p_brand"))
    keys = names.select(T.normalize_basic(F.replace("x", F.lit("#"), F.lit(" "))).alias("k"))
    return keys.groupBy(T.strip_numeric_variant(F.col("k")).alias("name_key")).agg(F.count("*").alias("rows_count"))


@REGISTRY.query(r"""
    SELECT doc_id, array_to_string(list_filter([
        CASE WHEN contains(text, '@') THEN 'has_at' END, CASE WHEN regexp_matches(text, '[0-9]') THEN 'has_digit' END,
        CASE WHEN contains(text, chr(10)) THEN 'has_lines' END, CASE WHEN length(text) > 5000 THEN 'long_text' END,
        CASE WHEN length(text) < 200 THEN 'short_text' END, CASE WHEN text = upper(text) THEN 'upper_case' END],
        lambda f: f IS NOT NULL), ',') AS flags
    FROM documents
""")
def txt_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    found = T.flags(
        has_at=F.contains(text, F.lit("@")),
        has_digit=text.rlike("[0-9]"),
        has_lines=F.contains(text, F.lit("\n")),
        long_text=F.length(text) > 5000,
        short_text=F.length(text) < 200,
        upper_case=text == F.upper(text),
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, ",").alias("flags"))


@REGISTRY.query(f"""
    SELECT doc_id, len({SQL_TOKENS.format('text')}) AS tokens_count,
        array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(text, ''), '[0-9]+(?:[.,][0-9]+)?'), lambda n: replace(n, ',', '.')))), ' ') AS numbers
    FROM documents
""")
def txt_tokens_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(T.tokens(text)).alias("tokens_count"), F.array_join(T.numbers(text), " ").alias("numbers"))


SQL_HEAD = "array_to_string(string_split(" + SQL_KEY.format("d.text") + ", ' ')[1:2], ' ')"


@REGISTRY.query(f"""
    WITH m AS (
        SELECT d.doc_id, d.source || '::' || string_split({SQL_KEY.format('d.text')}, ' ')[1] AS cluster_key, {SQL_HEAD} AS alias,
            (coalesce(l.quality, 0) + 1) / 3.0 AS confidence
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    )
    SELECT cluster_key, count(*) AS mentions_count, count(DISTINCT doc_id) AS documents_count,
        round(min(confidence), 6) AS confidence_min, round(avg(confidence), 6) AS confidence_avg, round(max(confidence), 6) AS confidence_max,
        array_to_string(list_sort(list(DISTINCT alias)), '|') AS aliases,
        CASE WHEN count(*) = 1 THEN 'isolated_mention' WHEN min(confidence) < max(confidence) THEN 'review_group' ELSE 'auto_merged' END AS cluster_status
    FROM m GROUP BY cluster_key
""")
def agg_auto_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    words = F.split(T.match_key(F.col("text")), " ")
    mentions = docs.select(
        "doc_id",
        F.concat("source", F.lit("::"), words[0]).alias("cluster_key"),
        F.array_join(F.slice(words, 1, 2), " ").alias("alias"),
        ((F.coalesce("quality", F.lit(0)) + 1) / F.lit(3.0)).alias("confidence"),
    )
    found = clusters.exact_clusters(mentions, "cluster_key", "doc_id", "alias", "confidence")
    return found.withColumn("aliases", F.array_join("aliases", "|"))


@REGISTRY.query("""
    WITH c AS (SELECT p_brand, p_name, count(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY ALL)
    SELECT p_brand, p_name AS display, n AS value_count FROM c
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, (p_name = lower(p_name)), length(p_name) DESC, p_name) = 1
""")
def agg_ordered_mode_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.ordered_mode(table(spark, sf_dir, "part"), ["p_brand"], "p_name")


@REGISTRY.query("""
    SELECT event_type, user_id, count(*) AS rows_count, round(avg(value), 6) AS value_avg,
        array_to_string(list_sort(list(DISTINCT event_id))[1:3], ',') AS examples
    FROM events GROUP BY event_type, user_id HAVING count(*) >= 3
""")
def agg_raw_value_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.frequent_values(table(spark, sf_dir, "events"), ["event_type", "user_id"], "event_id", "value", 3)
    return found.withColumn("examples", F.array_join(F.transform("examples", lambda e: e.cast("string")), ","))


@REGISTRY.query("""
    SELECT event_type, user_id % 3 AS role, count(*) AS rows_count, count(DISTINCT user_id) AS users_count, count(DISTINCT props) AS props_count
    FROM events GROUP BY ALL
""")
def agg_type_role_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("role", F.col("user_id") % 3)
    return events.groupBy("event_type", "role").agg(
        F.count("*").alias("rows_count"), F.countDistinct("user_id").alias("users_count"), F.countDistinct("props").alias("props_count")
    )


@REGISTRY.query("SELECT sha256(text) AS key, count(*) AS rows_count, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def agg_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.repeated_keys(table(spark, sf_dir, "documents"), F.sha2("text", 256), "doc_id")


@REGISTRY.query("""
    WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS INT) * 100 + hour(ts) AS k FROM events),
    g AS (SELECT event_type, k, count(DISTINCT user_id) AS docs, min(user_id) AS user_id, max(value) AS v FROM e GROUP BY ALL HAVING count(DISTINCT user_id) = 1),
    r AS (SELECT e.event_type, e.k, min(e.event_id) AS representative FROM e JOIN g ON e.event_type = g.event_type AND e.k = g.k AND e.value = g.v GROUP BY ALL)
    SELECT g.event_type, g.k, g.user_id, r.representative, count(*) OVER (PARTITION BY g.user_id) AS clusters_in_document, g.v >= 10 AS fast_path
    FROM g JOIN r ON g.event_type = r.event_type AND g.k = r.k
""")
def agg_singleton_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int") * 100 + F.hour("ts"))
    return clusters.single_document_clusters(events, ["event_type", "k"], "user_id", "event_id", "value", 10.0)


@REGISTRY.query("""
    WITH r AS (
        SELECT d.doc_id, d.lang, list_filter([CASE WHEN l.doc_id IS NULL THEN 'unlabelled' END, CASE WHEN l.quality = 0 THEN 'low_quality' END,
            CASE WHEN l.toxic = 1 THEN 'toxic' END, CASE WHEN length(d.text) < 200 THEN 'short' END], lambda x: x IS NOT NULL) AS reasons
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ), e AS (SELECT doc_id, lang, unnest(CASE WHEN len(reasons) > 0 THEN reasons ELSE ['unspecified'] END) AS reason FROM r)
    SELECT lang, reason, count(*) AS rows_count, count(DISTINCT doc_id) AS documents_count FROM e GROUP BY ALL
""")
def agg_explode_reason_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").withColumn("labelled", F.lit(True))
    docs = table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    reasons = T.flags(
        unlabelled=F.col("labelled").isNull(), low_quality=F.col("quality") == 0, toxic=F.col("toxic") == 1, short=F.length("text") < 200
    )
    return clusters.reason_summary(docs.withColumn("reasons", reasons), "reasons", ["lang"], "doc_id")


@REGISTRY.query("""
    WITH p AS (SELECT user_id, event_type, bool_or(value > 20) AS f FROM events GROUP BY ALL)
    SELECT user_id, count(*) AS tags_count, array_to_string(list_sort(list(event_type || ':' || CAST(f AS VARCHAR))), ',') AS tags FROM p GROUP BY user_id
""")
def agg_doc_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.tags_by_document(table(spark, sf_dir, "events").withColumn("f", F.col("value") > 20), "user_id", "event_type", "f")
