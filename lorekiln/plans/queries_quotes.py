"""Quotes, aliases and titles in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.functions import text as T
from lorekiln.operators import catalogue, matching, quotes
from lorekiln.plans.registry import Registry, table
from lorekiln.plans.sql_text import SQL_QUOTE_KEY, sql_basic
from lorekiln.sources.shared import Workspace

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql

#: Letters of a word that links an item to a document which has it, too.
LINKING = 8

SQL_FOUND = f"""
    q AS (SELECT item_id, regexp_replace(coalesce(text, ''), '^[ \\t\\n\\r\\f\\x0B]+|[ \\t\\n\\r\\f\\x0B]+$', '', 'g') AS raw, {SQL_QUOTE_KEY.format('text')} AS key FROM benchmark),
    d AS (SELECT doc_id, coalesce(text, '') AS text, {SQL_QUOTE_KEY.format('text')} AS body FROM documents),
    found AS (
        SELECT item_id, doc_id, CASE WHEN contains(text, raw) THEN 'exact' ELSE 'normalized_exact' END AS quote_status
        FROM q JOIN d ON contains(body, key) WHERE raw <> '' AND NOT contains(raw, '...') AND NOT contains(raw, '…')
    )
"""


def _found(spark: SparkSession, sf_dir: str, fuzzy: bool) -> DataFrame:
    return quotes.find_quotes(table(spark, sf_dir, "benchmark"), "item_id", "text", table(spark, sf_dir, "documents"), "doc_id", "text", fuzzy, twelfths=False)


@REGISTRY.query(f"WITH {SQL_FOUND} SELECT item_id, doc_id, quote_status FROM found")
def sim_quote_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes in all documents, as they are or but for case and white space."""
    return _found(spark, sf_dir, fuzzy=False)


@REGISTRY.query()
def sim_quote_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes in all documents, with changes anywhere in them too, at any place; tests compare it with
    a look at every window."""
    return _found(spark, sf_dir, fuzzy=True)


def _sentences(text: str) -> Column:
    parts = F.transform(F.split(T.text_or_empty(F.col(text)), r"[.!?\n]+"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def _long_words(text: str) -> Column:
    """Distinct words of ``LINKING`` letters at least."""
    return F.array_distinct(F.regexp_extract_all(F.lower(T.text_or_empty(F.col(text))), F.lit(rf"[\p{{L}}\p{{N}}_]{{{LINKING},}}"), F.lit(0)))


def match_inputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Items as tags. Aliases: an item's sentences (the first is canonical), their first two and first
    three words. Documents are linked where they share a long word with an item; a document's first
    line is its name, the others are its blocks. Evidence of a link: the item's sentences."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("tag"), _sentences("text").alias("sentences"), _long_words("text").alias("words"))
    each = items.select("tag", F.posexplode("sentences").alias("k", "s"))
    start = lambda n: F.array_join(F.slice(F.split("s", " "), F.lit(1), F.lit(n)), " ")
    aliases = each.select("tag", "k", F.explode(F.array("s", start(2), start(3))).alias("alias"), "s")
    aliases = aliases.select("tag", "alias", ((F.col("k") == 0) & (F.col("alias") == F.col("s"))).alias("canonical"))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc"), "text")
    lines = F.split(T.text_or_empty(F.col("text")), "\n")
    own = items.select("tag", F.explode("words").alias("word"))
    links = docs.select("doc", F.explode(_long_words("text")).alias("word")).join(quotes.small(own), "word").select("tag", "doc").distinct()
    alone = links.groupBy("doc").agg((F.count("*") == 1).alias("sole"))
    links = Workspace(spark, "match-inputs").keep(links.join(alone, "doc").withColumn("mention", F.concat("tag", F.lit(":"), "doc")), "links")
    return {
        "terms": matching.alias_terms(aliases, "tag", "alias", "canonical"),
        "links": links,
        "docs": docs.select("doc", lines[0].alias("name"), F.length("text").alias("length")),
        "blocks": docs.select("doc", F.posexplode(lines).alias("block_index", "text")).filter("block_index > 0"),
        "quotes": links.select("tag", "mention").join(each.select("tag", "s"), "tag").select("mention", F.col("s").alias("quote")),
    }


SQL_MATCH = rf"""
    i AS (SELECT CAST(item_id AS VARCHAR) AS tag, list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?\n]+'), lambda s: trim(s)), lambda s: s <> '') AS ss, text FROM benchmark),
    s AS (SELECT tag, unnest(ss) AS s, generate_subscripts(ss, 1) AS k FROM i),
    a AS (SELECT tag, k, s, unnest([s, array_to_string(string_split(s, ' ')[1:2], ' '), array_to_string(string_split(s, ' ')[1:3], ' ')]) AS alias FROM s),
    n AS (SELECT tag, {sql_basic('alias')} AS term, k = 1 AND alias = s AS canonical FROM a),
    terms AS (SELECT tag, term, bool_or(canonical) AS canonical, length(regexp_replace(term, '[^\p{{L}}\p{{N}}_]', '', 'g')) AS compact FROM n WHERE term <> '' GROUP BY ALL),
    d AS (SELECT CAST(doc_id AS VARCHAR) AS doc, string_split(coalesce(text, ''), chr(10)) AS ls, length(text) AS len, text FROM documents),
    dw AS (SELECT DISTINCT doc, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+')) AS word FROM d),
    iw AS (SELECT DISTINCT tag, unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+')) AS word FROM i),
    l AS (SELECT DISTINCT tag, doc FROM dw JOIN iw USING (word) WHERE length(word) >= {LINKING}),
    b AS (SELECT doc, k - 1 AS block_index, {sql_basic('line')} AS norm FROM (SELECT doc, unnest(ls) AS line, generate_subscripts(ls, 1) AS k FROM d WHERE doc IN (SELECT doc FROM l)) WHERE k > 1 AND trim(line) <> ''),
    f AS (SELECT doc, list(block_index ORDER BY block_index) AS filled FROM b GROUP BY doc),
    pairs AS (SELECT l.tag, l.doc, filled, len <= 12000 AND count(*) OVER (PARTITION BY l.doc) = 1 AS short, {sql_basic('ls[1]')} AS title FROM l JOIN f USING (doc) JOIN d USING (doc)),
    quoted AS (SELECT DISTINCT p.tag, p.doc, b.block_index FROM pairs p JOIN s USING (tag) JOIN b USING (doc) WHERE length({sql_basic('s.s')}) >= 8 AND contains(b.norm, {sql_basic('s.s')})),
    pattern AS (SELECT *, CASE WHEN regexp_matches(term, '^[\p{{L}}\p{{N}}]') THEN '(^|[^\p{{L}}\p{{N}}_])' ELSE '' END || regexp_escape(term)
        || CASE WHEN regexp_matches(term, '[\p{{L}}\p{{N}}]$') THEN '($|[^\p{{L}}\p{{N}}_])' ELSE '' END AS re FROM terms),
    named AS (
        SELECT p.tag, p.doc, b.block_index, bool_or(canonical OR compact >= 5) AS strong, list(term ORDER BY NOT canonical, length(term) DESC, term)[1:10] AS found
        FROM pairs p JOIN pattern t USING (tag) JOIN b USING (doc) WHERE compact >= 3 AND contains(b.norm, term) AND regexp_matches(b.norm, re) GROUP BY ALL
    ), hit AS (SELECT tag, doc FROM quoted UNION SELECT tag, doc FROM named),
    other AS (SELECT * FROM pairs WHERE (tag, doc) NOT IN (SELECT (tag, doc) FROM hit)),
    titled AS (
        SELECT o.tag, o.doc, any_value(CASE WHEN short THEN filled ELSE filled[1:1] END) AS filled, bool_or(canonical OR compact >= 5) AS strong,
            list(term ORDER BY NOT canonical, length(term) DESC, term)[1:10] AS found
        FROM other o JOIN pattern t USING (tag) WHERE contains(title, term) AND regexp_matches(title, re) GROUP BY ALL
    ), rest AS (SELECT * FROM other WHERE (tag, doc) NOT IN (SELECT (tag, doc) FROM titled))
    , hits AS (
        SELECT tag, doc, 'quote_match' AS method, 'high' AS quality, [block_index] AS bs, [tag || ':' || doc] AS ms, []::VARCHAR[] AS als, '' AS reasons FROM quoted
        UNION ALL SELECT tag, doc, 'alias_match', CASE WHEN strong THEN 'high' ELSE 'medium' END, [block_index], [], found, '' FROM named
        UNION ALL SELECT tag, doc, 'title_match', CASE WHEN strong THEN 'medium' ELSE 'low' END, filled, [], found, CASE WHEN strong THEN '' ELSE 'title_match_short_or_ambiguous_alias' END FROM titled
        UNION ALL SELECT tag, doc, 'short_doc_fallback', 'medium', filled, [tag || ':' || doc], [], '' FROM rest WHERE short
        UNION ALL SELECT tag, doc, 'mention_only_fallback', 'low', filled[1:1], [tag || ':' || doc], [], 'mention_only_fallback_no_quote_alias_or_title_match' FROM rest WHERE NOT short
    )
"""


@REGISTRY.query(f"""
    WITH {SQL_MATCH} SELECT tag, doc, method, quality, array_to_string(bs, ',') AS block_indexes, array_to_string(ms, ',') AS mention_ids,
        array_to_string(als, '|') AS matched_aliases, reasons <> '' AS needs_review, reasons AS review_reasons FROM hits
""")
def jn_match_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes, aliases of several words and titles within the documents of each tag."""
    hits = matching.find_match_hits(**match_inputs(spark, sf_dir))
    joined = lambda c, mark: F.array_join(F.transform(c, lambda x: x.cast("string")), mark).alias(c)
    return hits.select(
        "tag", "doc", "method", "quality", joined("block_indexes", ","), joined("mention_ids", ","), joined("matched_aliases", "|"), "needs_review", joined("review_reasons", ",")
    )


@REGISTRY.query(f"""
    WITH {SQL_MATCH}, ranked AS (SELECT tag, doc, method, list_position(['quote_match', 'alias_match', 'title_match', 'short_doc_fallback', 'mention_only_fallback'], method) AS m,
        list_position(['high', 'medium', 'low'], quality) AS q, bs[1] AS b FROM hits)
    SELECT tag, doc, method AS first_method, m, q, b AS first_block, n AS hits_count FROM (
        SELECT *, row_number() OVER (PARTITION BY tag, doc ORDER BY m, q, b) AS r, count(*) OVER (PARTITION BY tag, doc) AS n FROM ranked) WHERE r = 1
""")
def top_first_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first hit of each tag and document, by method, quality and block."""
    method, quality, block = matching.in_order()
    hits = matching.find_match_hits(**match_inputs(spark, sf_dir)).select("tag", "doc", "method", method.alias("m"), quality.alias("q"), block.alias("b"))
    best = hits.groupBy("tag", "doc").agg(F.min(F.struct("m", "q", "b", "method")).alias("best"), F.count("*").alias("hits_count"))
    return best.select("tag", "doc", F.col("best.method").alias("first_method"), "best.m", "best.q", F.col("best.b").alias("first_block"), "hits_count")


@REGISTRY.query(rf"""
    WITH c AS (SELECT p_brand AS tag, p_type AS entity_type, p_name AS alias, CASE WHEN p_size % 4 = 0 THEN p_type ELSE '' END AS alias_latin, p_partkey AS place,
            ['n3_canonical', 'n1_canonical_candidate_ru', 'n1_surface', 'n1_auto_cluster_alias', 'n3_label', 'n1_canonical_candidate_latin', 'n4_generated'][p_size % 7 + 1] AS source, p_size % 7 AS rank
        FROM part UNION ALL SELECT p_brand, p_type, upper(p_name) || '.', '', p_partkey, 'n4_generated', 6 FROM part),
    k AS (SELECT *, {sql_basic('alias')} AS n FROM c),
    o AS (SELECT * FROM k WHERE n <> '' QUALIFY row_number() OVER (PARTITION BY tag, entity_type, n ORDER BY rank, length(alias), place, alias) = 1),
    m AS (SELECT p_brand AS tag, {sql_basic('p_name')} AS n, count(*) AS mentions, count(DISTINCT p_size) AS docs FROM part GROUP BY ALL),
    b AS (SELECT DISTINCT p_brand AS tag, {sql_basic('p_name')} AS n FROM part WHERE p_retailprice > 2000),
    s AS (SELECT o.*, coalesce(mentions, 0) AS mentions, coalesce(docs, 0) AS docs, b.n IS NOT NULL AS blocked FROM o LEFT JOIN m USING (tag, n) LEFT JOIN b USING (tag, n)),
    i AS (SELECT DISTINCT entity_type, tag, unnest([n, {sql_basic('alias_latin')}]) AS v FROM s WHERE NOT blocked),
    t AS (SELECT entity_type, v FROM i WHERE v <> '' GROUP BY ALL HAVING count(DISTINCT tag) > 1)
    SELECT 'al_' || substr(sha256(tag || chr(10) || s.entity_type || chr(10) || n), 1, 16) AS alias_id, tag, s.entity_type, alias, n AS alias_norm, alias_latin, source AS alias_source,
        CASE WHEN blocked THEN 'blocked_active_substance_candidate' ELSE 'active' END AS alias_status, mentions AS mention_count, docs AS document_count, t.v IS NOT NULL AS conflict,
        blocked OR t.v IS NOT NULL AS needs_review, concat_ws(',', CASE WHEN t.v IS NOT NULL THEN 'alias_conflict' END, CASE WHEN blocked THEN 'blocked_active_substance_candidate' END) AS review_reasons
    FROM s LEFT JOIN t ON t.entity_type = s.entity_type AND t.v = n
""")
def cls_alias_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands as tags, names of their parts as aliases from several sources."""
    parts = table(spark, sf_dir, "part")
    source = F.element_at(F.array(*map(F.lit, catalogue.SOURCES)), (F.col("p_size") % 7 + 1).cast("int"))
    columns = [F.col("p_brand").alias("tag"), F.col("p_type").alias("entity_type")]
    named = parts.select(*columns, F.col("p_name").alias("alias"), F.when(F.col("p_size") % 4 == 0, F.col("p_type")).otherwise("").alias("alias_latin"), source.alias("source"), F.col("p_partkey").alias("place"))
    loud = parts.select(*columns, F.concat(F.upper("p_name"), F.lit(".")), F.lit(""), F.lit("n4_generated"), F.col("p_partkey"))
    norm = T.normalize_label(F.col("p_name")).alias("alias_norm")
    counts = parts.select(F.col("p_brand").alias("tag"), norm, "p_size").groupBy("tag", "alias_norm").agg(F.count("*").alias("mention_count"), F.countDistinct("p_size").alias("document_count"))
    blocked = parts.filter("p_retailprice > 2000").select(F.col("p_brand").alias("tag"), norm)
    rows = catalogue.alias_rows(named.union(loud), counts, blocked)
    return rows.withColumn("review_reasons", F.array_join("review_reasons", ","))
