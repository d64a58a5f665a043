"""Shards of near equal bytes by k-d partitioning of document metadata.

A node is split along the dimension in which its documents spread widest, at the weighted
median that gives each side its share of the shards, until a leaf holds one shard's bytes: those
of ``target_bytes``, or an equal share. Spread is the range between two quantiles, so that a
few outliers don't decide; dimensions are scaled by quantiles as well, and what lies beyond
them counts as the last value there.
Medians are found for all nodes of a level at once, by sums over ranges of key bits that
narrow from pass to pass; the driver sees a few numbers per node. Keys end in a hash, so a
value that very many documents share is split as evenly as any other.

Defined results
    a document weighs its UTF-8 bytes (null: none) plus a fixed overhead.
    null metadata counts as the least value; repeated rows are placed once each.
    an empty table gives an empty result; fewer documents than shards leave shards empty.
    other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace

OVERHEAD = 16
#: Quantiles that a dimension's scale spans, and those that a node's spread lies between.
SCALE, SPREAD = (0.01, 0.99), (0.1, 0.9)
ACCURACY = 10_000
#: Bits of a dimension's value, of the hash that breaks ties, and that one pass resolves.
VALUE_BITS, TIE_BITS, PASS_BITS = 20, 22, 14
#: Rows that one task numbers at most, and the least number of groups in a shard.
NUMBERED, LEAST_GROUPS = 20_000, 16


def document_dimensions(docs: DataFrame, text_col: str = "text") -> dict[str, Column]:
    """Length, language and source where these columns exist; names are ordered by hash."""
    found = {"length": F.octet_length(F.coalesce(F.col(text_col), F.lit("")))}
    for name in ("lang", "source"):
        if name in docs.columns:
            found[name] = F.crc32(F.col(name).cast("string"))
    return found


def _quantiles(column: Column | str, shares: tuple[float, float]) -> Column:
    return F.percentile_approx(column, list(shares), ACCURACY)


def _scaled(rows: DataFrame, count: int) -> DataFrame:
    """Raw dimensions as whole numbers of VALUE_BITS over each one's scale."""
    ends = rows.agg(F.lit(0), *[_quantiles(f"raw{k}", SCALE).alias(f"ends{k}") for k in range(count)]).first()
    top, values = (1 << VALUE_BITS) - 1, []
    for k in range(count):
        low, high = ends[f"ends{k}"] or (0.0, 0.0)
        # A scale without width still tells what lies below, on and above it.
        scaled = (F.col(f"raw{k}") - low) * (top / (high - low)) if high > low else F.signum(F.col(f"raw{k}") - low) + 1
        values.append(F.greatest(F.lit(0), F.least(F.lit(top), F.coalesce(F.floor(scaled), F.lit(0)))).cast("long"))
    return rows.select("id", "row", "size", "crc", F.array(*values).alias("values"), F.pmod(F.xxhash64("id", "row"), F.lit(1 << TIE_BITS)).alias("tie"))


NODES = "node int, half int, dim int, want double, base bigint, bound bigint"


def _split(rows: DataFrame, nodes: dict[int, int], count: int) -> DataFrame:
    """``rows`` with the node of each after all ``nodes`` (first shard: number of shards) are
    split. What is known of the nodes is a small table, a row per node, that meets the rows."""
    spark = rows.sparkSession

    def table() -> DataFrame:
        return F.broadcast(spark.createDataFrame([(node, *known[node]) for node in known], NODES))  # fewer rows than shards

    spread = rows.groupBy("node").agg(F.sum("size").alias("size"), *[_quantiles(F.col("values")[k], SPREAD).alias(f"q{k}") for k in range(count)])
    known = {}
    for row in spread.collect():  # a row per node
        if row["node"] in nodes:
            n = nodes[row["node"]]
            widths = [row[f"q{k}"][1] - row[f"q{k}"][0] for k in range(count)]
            known[row["node"]] = [n // 2, widths.index(max(widths)), row["size"] * (n // 2) / n, 0, 0]
    if not known:
        return rows
    key = F.get("values", "dim") * (1 << TIE_BITS) + F.col("tie")
    bits = VALUE_BITS + TIE_BITS
    while bits > 0:
        bits -= PASS_BITS
        cells = rows.join(table(), "node").withColumn("cell", F.shiftright(key, bits)).filter(F.shiftright("cell", PASS_BITS) == F.col("bound"))
        sums = cells.groupBy("node", "cell", "want", "base").agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(Window.partitionBy("node").orderBy("cell"))  # 2 ** PASS_BITS cells at most
        sums = sums.withColumn("upto", upto + F.col("base")).filter("upto >= want")
        for r in sums.groupBy("node").agg(F.min(F.struct("cell", "size", "upto")).alias("at")).collect():
            cell, size, upto = r["at"]
            _, _, want, _, _ = known[r["node"]]
            if not bits:  # the last cell goes to the side that comes closer
                cell += int(upto - want <= want - upto + size)
            known[r["node"]][3:] = [upto - size, cell]
    placed = rows.join(table(), "node", "left")
    right = F.coalesce(key >= F.col("bound"), F.lit(False))
    return placed.withColumn("node", F.when(right, F.col("node") + F.col("half")).otherwise(F.col("node"))).select(rows.columns)


def _numbered(rows: DataFrame, most: int) -> DataFrame:
    """``slot``: gapless from 0 in each shard; groups of a shard are numbered apart."""
    groups = max(LEAST_GROUPS, -(-most // NUMBERED))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("row", F.lit("slot")), F.lit(groups)).cast("int"))
    counts = dealt.groupBy("shard", "group").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("shard", "group", F.coalesce(before, F.lit(0)).alias("offset"))
    order = Window.partitionBy("shard", "group").orderBy("row")
    inside = dealt.withColumn("place", F.row_number().over(order) - 1)
    return inside.join(offsets, ["shard", "group"]).withColumn("slot", F.col("offset") + F.col("place"))


def shard(
    docs: DataFrame,
    shards: int = 40,
    dimensions: dict[str, Column] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_bytes: int | None = None,
) -> DataFrame:
    """A row per document: its id, size, text_crc32, shard and slot. With ``target_bytes``, there
    are as many shards as that size asks for, whatever ``shards`` says."""
    work = Workspace(docs.sparkSession, "kd-sharding")
    chosen = list((dimensions or document_dimensions(docs, text_col)).values())
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        *[d.cast("double").alias(f"raw{k}") for k, d in enumerate(chosen)],
    )
    rows = work.keep(_scaled(work.keep(raw, "raw"), len(chosen)), "rows")
    if target_bytes:
        shards = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // target_bytes))
    placed = rows.withColumn("node", F.lit(0))
    nodes = {0: shards} if not rows.isEmpty() else {}
    level = 0
    while nodes := {first: n for first, n in nodes.items() if n > 1}:
        placed = work.keep(_split(placed, nodes, len(chosen)), f"level-{level}")
        if level:
            work.drop(f"level-{level - 1}")
        nodes = {first: n // 2 for first, n in nodes.items()} | {first + n // 2: n - n // 2 for first, n in nodes.items()}
        level += 1
    placed = placed.select("id", "row", "size", "crc", F.col("node").cast("int").alias("shard"))
    most = placed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    return _numbered(placed, most).select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", "slot")
