"""Work plans: strategies, their repair, task queues, sources of articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed thresholds of documents per tag.
FEW_DOCUMENTS, MANY_DOCUMENTS = 3, 20


def strategy(documents: Column, candidate: Column, review: Column, coverage: Column) -> Column:
    """The first rule that holds."""
    return (
        F.when(documents == 0, "stub_only")
        .when(review & ~candidate, "review_stub")
        .when(~candidate, "context_stub")
        .when((documents == 1) & (coverage >= 0.8), "direct_copy_candidate")
        .when(documents <= FEW_DOCUMENTS, "small_compile")
        .when(documents <= MANY_DOCUMENTS, "compile")
        .otherwise("chunked_compile")
    )


def repaired(strategy_col: Column, documents: Column, blocking: Column) -> Column:
    """Review stubs whose reasons don't block go back to a compiling strategy."""
    again = F.when(documents <= FEW_DOCUMENTS, "small_compile").when(documents <= MANY_DOCUMENTS, "compile").otherwise("chunked_compile")
    return F.when((strategy_col == "review_stub") & ~blocking & (documents > 0), again).otherwise(strategy_col)


def task_queue(plans: DataFrame, plan_key: str, windows: DataFrame, window_key: str) -> DataFrame:
    """A task per window of a plan; plans without windows have none."""
    return plans.join(windows, plans[plan_key] == windows[window_key])


def first_source(sources: list[tuple[str, Column]], fallback: str = "missing") -> Column:
    """The name of the first source that is there."""
    chain = F.lit(fallback)
    for name, there in reversed(sources):
        chain = F.when(there, name).otherwise(chain)
    return chain


def group_status(blocked: Column, size: Column, score: Column, most: int, high: float) -> tuple[Column, Column]:
    """(status, priority) of a candidate group; the first rule that holds decides."""
    status = F.when(blocked > 0, "blocked").when(size < 2, "singleton").when(size > most, "too_large").when(score >= high, "ready").otherwise("low_confidence")
    priority = F.when(status == "ready", F.when(score >= (1 + high) / 2, "high").otherwise("normal")).otherwise("none")
    return status, priority
