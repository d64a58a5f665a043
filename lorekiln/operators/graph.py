"""Connected components by alternating star operations on edge tables."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _smallest(rows: DataFrame, work: Workspace, table: str) -> DataFrame:
    """The least neighbour of each node, as a table: the join with the rows it came from
    then has two plain sides, and a hub's partition can be split."""
    return work.keep(rows.groupBy("node").agg(F.min("other").alias("least")), table)


def connected_components(edges: DataFrame, work: Workspace, left: str = "src", right: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``: component is the smallest node that
    links reach. Null ends and loops link nothing; loops keep their node. Rounds go on until the
    edges stay as they are; their number grows with the logarithm of the longest chain."""
    pairs = edges.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    pairs = work.keep(pairs.select(F.greatest(left, right).alias("big"), F.least(left, right).alias("small")).distinct(), "links")
    now = pairs.filter("big <> small")
    state, table = None, None
    for turn in count():
        # Large star: larger neighbours of a node move to the least of its neighbourhood.
        both = now.select(F.col("big").alias("node"), F.col("small").alias("other")).union(
            now.select(F.col("small").alias("node"), F.col("big").alias("other"))
        )
        least = _smallest(both, work, f"least-{turn}")
        moved = both.filter("other > node").join(least, "node")
        large = work.keep(
            moved.select(F.col("other").alias("big"), F.least("least", "node").alias("small")).distinct(), f"large-{turn}"
        )
        # Small star: a node and its smaller neighbours move to the least of these.
        rows = large.select(F.col("big").alias("node"), F.col("small").alias("other"))
        down = _smallest(rows, work, f"down-{turn}")
        inner = rows.join(down, "node").filter("other <> least").select(F.col("other").alias("big"), F.col("least").alias("small"))
        own = down.select(F.col("node").alias("big"), F.col("least").alias("small"))
        small = work.keep(inner.union(own).distinct(), f"small-{turn}")
        for done in (table, f"least-{turn}", f"large-{turn}", f"down-{turn}"):
            if done:
                work.drop(done)
        now, table = small, f"small-{turn}"
        before, state = state, _state(now)
        if state == before or not state[0]:
            break
    nodes = pairs.select(F.col("big").alias("node")).union(pairs.select(F.col("small").alias("node"))).distinct()
    found = now.select(F.col("big").alias("node"), F.col("small").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
