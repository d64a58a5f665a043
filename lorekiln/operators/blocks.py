"""Documents as ordered blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import text as T

HEADER_LENGTH = 60
def source_id(row: Column, content: Column) -> Column:
    """A document's stable id: its row and the beginning of its content hash."""
    return F.concat(F.lit("doc_"), F.lpad(row.cast("string"), 6, "0"), F.lit("_"), F.left(F.sha2(content, 256), F.lit(8)))


def numbered_copies(df: DataFrame, id_col: str, order: str) -> DataFrame:
    """Ids that occur again get ``_dup2``, ``_dup3``, ... in order."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy(id_col).orderBy(order))
    return df.withColumn("__n", n).withColumn(id_col, F.when(F.col("__n") > 1, F.concat(F.col(id_col), F.lit("_dup"), F.col("__n"))).otherwise(F.col(id_col))).drop("__n")


def line_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per line: block_index, block_id, block_type, text, text_length, parse_status."""
    lines = docs.select(id_col, F.posexplode(F.split(T.text_or_empty(F.col(text_col)), "\n")).alias("block_index", "line"))
    text = F.trim("line")
    kind = (
        F.when(text == "", "empty")
        .when(text.startswith("- "), "list")
        .when((F.length(text) <= HEADER_LENGTH) & ~text.rlike(r"[.,:;!?]$"), "header")
        .otherwise("paragraph")
    )
    return lines.select(
        id_col,
        "block_index",
        F.concat(F.lit("b_"), F.lpad((F.col("block_index") + 1).cast("string"), 6, "0")).alias("block_id"),
        kind.alias("block_type"),
        text.alias("text"),
        F.length(text).alias("text_length"),
        F.when(text == "", "empty_or_unhandled_block").otherwise("ok").alias("parse_status"),
    )


def integrity_violations(docs: DataFrame, children: DataFrame, id_col: str, child_col: str, length_col: str, text_col: str) -> DataFrame:
    """(violation, key): repeated ids, children without a parent, parents without a child,
    lengths that the text doesn't have."""
    key = F.col(id_col).cast("string").alias("key")
    repeated = docs.groupBy(id_col).count().filter("count > 1").select(F.lit("duplicate_id").alias("violation"), key)
    orphan = children.join(docs, children[child_col] == docs[id_col], "left_anti").select(F.lit("orphan_child"), F.col(child_col).cast("string"))
    missing = docs.join(children, docs[id_col] == children[child_col], "left_anti").select(F.lit("missing_child"), key)
    wrong = docs.filter(F.col(length_col) != F.length(text_col)).select(F.lit("length_mismatch"), key)
    return repeated.union(orphan).union(missing).union(wrong)


def flat_records(df: DataFrame, id_col: str, raw_col: str) -> DataFrame:
    """Records ``{doc_id, entities: [...]}`` as a row per entity: (id, doc_id, entity_index, entity,
    invalid). A row with ``invalid`` stands for a record or an entity that is not usable."""
    raw = F.col(raw_col)
    listed = df.select(
        F.col(id_col), F.get_json_object(raw, "$.doc_id").alias("doc_id"), F.get_json_object(raw, "$").isNotNull().alias("__json"),
        F.get_json_object(raw, "$.entities").alias("__raw"), F.from_json(F.get_json_object(raw, "$.entities"), "array<string>").alias("__list"),
    )
    broken = F.when(~F.col("__json"), "invalid_json").when(F.col("doc_id").isNull(), "missing_doc_id")
    broken = broken.when(F.col("__raw").isNotNull() & ~F.ltrim("__raw").startswith("["), "entities_not_a_list")
    rows = listed.withColumn("__broken", broken).select(
        id_col, "doc_id", "__broken", F.posexplode_outer(F.when(F.col("__broken").isNull(), F.col("__list"))).alias("entity_index", "entity")
    )
    rows = rows.filter("__broken is not null or entity_index is not null")  # a list without entities gives no row
    no_object = F.when(F.col("entity").isNull() | ~F.ltrim("entity").startswith("{"), "entity_not_an_object")
    return rows.withColumn("invalid", F.coalesce("__broken", no_object)).drop("__broken")


def block_issues(blocks: DataFrame) -> DataFrame:
    """Blocks whose structure is not sound, with the issue."""
    text = F.col("text")
    issue = F.when(F.col("block_type") == "empty", "empty_block")
    issue = issue.when((F.col("block_type") == "list") & (F.trim(F.substring(text, 3, 2**31 - 1)) == ""), "empty_list_item")
    issue = issue.when((F.col("block_type") == "header") & ~text.rlike(r"\p{L}"), "header_without_letters")
    return blocks.withColumn("issue", issue).filter("issue is not null")
