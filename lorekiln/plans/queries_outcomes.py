"""Outcomes of work: which are active, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.plans.registry import Registry, table
from lorekiln.streaming import outcomes

REGISTRY = Registry()
QUERIES, ORACLE_SQL = REGISTRY.queries, REGISTRY.sql

SQL_SETTLED = """
    e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, ts AS made, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS outcome, props AS record
        FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
    s AS (SELECT *, sha256(outcome || chr(0) || coalesce(record, chr(1))) AS digest FROM e),
    settled AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY made DESC, digest DESC) = 1 AS active FROM s)
"""


def _settled(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("outcome", F.when(F.col("event_type") == "error", "failure").otherwise("success"))
    return outcomes.settled(outcomes.digests(events, "user_id", "ts", "outcome", "props"))


@REGISTRY.query(f"WITH {SQL_SETTLED} SELECT key, outcome, active, count(*) AS outcomes_count, min(digest) AS first_digest FROM settled GROUP BY ALL")
def udf_active_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users' events as outcomes: one is active, success or failure, the others are history."""
    return _settled(spark, sf_dir).groupBy("key", "outcome", "active").agg(F.count("*").alias("outcomes_count"), F.min("digest").alias("first_digest"))


@REGISTRY.query(f"""
    WITH {SQL_SETTLED}, h AS (SELECT key, outcome FROM settled WHERE active AND coalesce(json_extract_string(record, '$.k'), '') = '7')
    SELECT doc_id, CASE WHEN trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f\\x0B]+', ' ', 'g')) = '' THEN 'empty_text' WHEN outcome = 'success' THEN 'done'
        WHEN outcome = 'failure' THEN 'failed' ELSE 'pending' END AS verdict
    FROM documents LEFT JOIN h ON CAST(doc_id AS VARCHAR) = key
""")
def udf_pending_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that an active outcome with the same settings has not settled yet."""
    found = outcomes.pending(table(spark, sf_dir, "documents"), "doc_id", "text", _settled(spark, sf_dir), {"k": "7"})
    return found.select("doc_id", "verdict")
