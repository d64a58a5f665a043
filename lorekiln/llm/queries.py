"""The queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.llm import bpe_words, embedding_dedup, exact_dedup, fill_in_middle, kd_sharding, lang_id, licenses, packing, secrets, simhash_dedup, token_store, turn_repair, warc
from lorekiln.llm.sql import LICENSE_SQL, REPAIR_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(spark, warc.archive(_table(spark, sf_dir, "pages")))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        rank = secrets.KINDS.index(kind)
        return F.size(F.filter("named", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.spans_text(F.col("named")), 256).alias("base_sha256"),
        secrets.spans_text(F.col("secrets")).alias("spans"),
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    model = lang_id.fit(docs.filter(~held_out))
    found = lang_id.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out.alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected"
    )


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.write_store(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_store.read_documents(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.classes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_sharding.shard(_table(spark, sf_dir, "documents"), shards=40)
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    found = bpe_words.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, round_trip=True)
    return found.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with faults, by a hash of conversation and turn: one in twenty turns each is
    dropped, loses its text, loses its full stops, comes twice, is a user's."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    fault = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    copies = F.array_repeat(F.lit(0), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1))
    return turns.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"), F.explode(copies).alias("copy"),
    ).drop("copy")


def _hashed_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order of their conversation to a hash of each conversation's lines."""
    conv, digest, schema = None, None, None
    for batch in batches:
        schema = pa.schema([batch.schema.field("conv"), ("repaired_sha256", pa.string())])
        out = []
        for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if digest is None or key != conv:
                if digest is not None:
                    out.append({"conv": conv, "repaired_sha256": digest.hexdigest()})
                conv, digest = key, hashlib.sha256(line.encode())
            else:
                digest.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_pylist(out, schema)
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"conv": conv, "repaired_sha256": digest.hexdigest()}], schema)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash over a conversation's lines can only be worked out from first to last: sorted lines
    pass through a task one by one, and nothing of them is held."""
    turns = _table(spark, sf_dir, "conversations")
    repaired = turn_repair.repair(damaged(turns))
    lines = repaired.turns.select("conv", F.concat_ws(":", "role", "text").alias("line"), "at", "k")
    kind = turns.schema["conv_id"].dataType.simpleString()
    lines = lines.repartition("conv").sortWithinPartitions("conv", "at", "k").select("conv", "line")
    digests = lines.mapInArrow(_hashed_lines, f"conv {kind}, repaired_sha256 string")
    every = turns.select("conv_id").distinct()
    report, digests = repaired.report.withColumnRenamed("conv", "__conv"), digests.withColumnRenamed("conv", "__hashed")
    found = every.join(report, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").join(digests, F.col("conv_id").eqNullSafe(F.col("__hashed")), "left")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    gaps = F.when(F.col("audit").isNull(), 0).otherwise(F.col("gaps")).alias("gaps")
    return found.select(
        "conv_id", gaps, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda labels: F.array_join(F.array_sort(F.coalesce(labels, F.array().cast("array<string>"))), ",")
    named = F.col("named")
    sums = found.spans.groupBy("row").agg(
        F.count(F.when(named, 1)).alias("n_base"), F.min(F.when(named, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(named, F.col("start"))).cast("long").alias("last_word"), F.collect_set(F.when(named, F.col("label"))).alias("base"),
        F.collect_set("label").alias("every"), F.max("score").alias("score"),
    )
    return found.documents.join(sums, "row", "left").select(
        F.col("id").alias("doc_id"), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        joined(F.col("base")).alias("base_labels"), joined(F.col("every")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.rearrange(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("fim.output"), F.col("fim.form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_warc_archive": op1_warc_archive,
    "op2_secret_scan": op2_secret_scan,
    "op3_packing": op3_packing,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_kd_sharding": op6_kd_sharding,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language_id": op8_language_id,
    "op9_token_store": op9_token_store,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_turn_repair": op11_turn_repair,
    "op12_license_scan": op12_license_scan,
    "op13_fill_in_middle": op13_fill_in_middle,
}

#: The scan once more: match positions from gaps and matches, windows row by row. Patterns and
#: thresholds are written out, so that they don't come from the operator.
SECRET_SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    f AS (
        SELECT doc_id, 'assign' AS kind, regexp_extract_all(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS m,
            regexp_split_to_array(t, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)') AS g FROM d
        UNION ALL SELECT doc_id, 'access', regexp_extract_all(t, 'AKIA[A-Z0-9]{16,}'), regexp_split_to_array(t, 'AKIA[A-Z0-9]{16,}') FROM d
        UNION ALL SELECT doc_id, 'hex', regexp_extract_all(t, '[0-9a-f]{24,}'), regexp_split_to_array(t, '[0-9a-f]{24,}') FROM d
        UNION ALL SELECT doc_id, 'hex_run', regexp_extract_all(t, '[0-9a-fA-F]{20,}'), regexp_split_to_array(t, '[0-9a-fA-F]{20,}') FROM d
        UNION ALL SELECT doc_id, 'candidate', regexp_extract_all(t, '[A-Za-z0-9+/_=-]{20,}'), regexp_split_to_array(t, '[A-Za-z0-9+/_=-]{20,}') FROM d
    ), i AS (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM f),
    p AS (SELECT doc_id, kind, m[i] AS word, list_sum([length(x) for x in g[1:i]])::BIGINT + coalesce(list_sum([length(x) for x in m[1:i - 1]]), 0)::BIGINT AS start FROM i),
    base AS (
        SELECT doc_id, kind, start, start + length(word) AS stop FROM p WHERE kind IN ('access', 'hex') OR kind = 'assign'
            AND length(regexp_extract(word, '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2)) >= 6
    ), classed AS (
        SELECT doc_id, start, word, 'entropy_hex' AS kind, 3.05 AS bits FROM p WHERE kind = 'hex_run' AND regexp_matches(word, '[0-9]') AND regexp_matches(word, '[a-fA-F]')
        UNION ALL
        SELECT doc_id, start, word,
            CASE WHEN regexp_matches(word, '[a-z]') AND regexp_matches(word, '[A-Z]') AND regexp_matches(word, '[0-9]') THEN 'entropy_mixed'
                WHEN regexp_matches(word, '[A-Za-z]') AND regexp_matches(word, '[0-9]') THEN 'entropy_single_case' ELSE 'entropy_letters' END,
            CASE WHEN regexp_matches(word, '[a-z]') AND regexp_matches(word, '[A-Z]') AND regexp_matches(word, '[0-9]') THEN 3.75
                WHEN regexp_matches(word, '[A-Za-z]') AND regexp_matches(word, '[0-9]') THEN 3.65 ELSE 4.0 END
        FROM p WHERE kind = 'candidate' AND regexp_matches(word, '[^0-9a-fA-F]')
            AND NOT regexp_matches(word, '^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$')
            AND NOT regexp_matches(word, '^[A-Za-z]+[-_]?[0-9]{1,4}$') AND NOT regexp_matches(word, '^/?([A-Za-z]+|[0-9]+)([/_-]+([A-Za-z]+|[0-9]+))+/?$')
    ), w AS (SELECT *, unnest(range(0, length(word) - 20 + 1)) AS a FROM classed),
    hot AS (SELECT * FROM w WHERE list_aggregate(string_split(substr(word, a + 1, 20), ''), 'entropy') >= bits),
    fresh AS (SELECT *, CASE WHEN lag(a) OVER o IS NULL OR a > lag(a) OVER o + 20 THEN 1 ELSE 0 END AS f FROM hot WINDOW o AS (PARTITION BY doc_id, start, kind ORDER BY a)),
    run AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, start, kind ORDER BY a) AS r FROM fresh),
    more AS (
        SELECT doc_id, kind, start + min(a) AS start, start + max(a) + 20 AS stop, substr(any_value(word), min(a) + 1, max(a) + 20 - min(a)) AS own
        FROM run GROUP BY doc_id, kind, start, r
    ), every AS (
        SELECT *, list_position(['assign', 'access', 'hex', 'entropy_hex', 'entropy_mixed', 'entropy_single_case', 'entropy_letters'], kind) AS rank,
            kind || ':' || start || ':' || stop AS span
        FROM (SELECT doc_id, kind, start, stop FROM base UNION ALL SELECT doc_id, kind, start, stop FROM more
            WHERE (length(own) - length(regexp_replace(own, '(?i)example|placeholder|changeme|abcdefgh|12345678|x{6,}|0{6,}', '', 'g'))) * 8 < length(own))
    ), n AS (
        SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
            string_agg(span, ',' ORDER BY start, rank, stop) FILTER (WHERE rank <= 3) AS named, string_agg(span, ',' ORDER BY start, rank, stop) AS spans FROM every GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
        sha256(coalesce(named, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN n ON d.doc_id = n.doc_id
"""

ORACLE_SQL = {
    "op2_secret_scan": SECRET_SQL,
    "op11_turn_repair": REPAIR_SQL,
    "op12_license_scan": LICENSE_SQL,
    "op1_warc_archive": """
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        g AS (SELECT payload, max(page_id) AS response FROM p GROUP BY payload),
        d AS (
            SELECT p.page_id, octet_length(p.payload) AS payload_bytes, g.response,
                list_transform(range(0, 160), lambda i: CAST(
                    ('0x' || substr(sha1(p.payload), 1 + i // 4, 1))::INT >> (3 - i % 4) & 1 AS INT)) AS bits
            FROM p JOIN g ON p.payload = g.payload
        )
        SELECT page_id, payload_bytes,
            list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + 16 * bits[5 * k + 1] + 8 * bits[5 * k + 2] + 4 * bits[5 * k + 3] + 2 * bits[5 * k + 4] + bits[5 * k + 5],
                1)), 'string_agg', '') AS payload_digest,
            CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> response THEN response END AS refers_to
        FROM d
    """,
    "op4_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        ), g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
        FROM t JOIN g ON t.norm = g.norm
    """,
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), link AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
            ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
        ), reach AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION SELECT r.vec_id, l.b FROM reach r JOIN link l ON r.other = l.a
        ), n AS (SELECT a AS vec_id, count(*) AS n FROM link GROUP BY a),
        c AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id)
        SELECT c.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
        FROM c LEFT JOIN n ON c.vec_id = n.vec_id
    """,
}
