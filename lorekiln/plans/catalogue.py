"""Queries over the driver's tables, one per operator, with their SQL."""

from __future__ import annotations

from lorekiln.plans import queries_evidence, queries_matching, queries_outcomes, queries_quotes, queries_review, queries_text
from lorekiln.plans.queries_text import flagship

QUERIES = queries_text.QUERIES | queries_matching.QUERIES | queries_evidence.QUERIES | queries_outcomes.QUERIES | queries_quotes.QUERIES | queries_review.QUERIES
ORACLE_SQL = queries_text.ORACLE_SQL | queries_matching.ORACLE_SQL | queries_evidence.ORACLE_SQL | queries_outcomes.ORACLE_SQL | queries_quotes.ORACLE_SQL | queries_review.ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
