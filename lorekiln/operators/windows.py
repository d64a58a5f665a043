"""Frames, islands, ranks and running budgets over ordered rows."""

from __future__ import annotations

from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.operators.ranges import Ranges, Running
from lorekiln.sources.shared import Workspace

_EXIT = pa.struct([("begun", pa.int64()), ("rows", pa.int64()), ("total", pa.float64())])
_ENDS = pa.schema([
    ("part", pa.int64()), ("first_key", pa.string()), ("last_key", pa.string()), ("whole", pa.bool_()), ("length", pa.int64()),
    ("head", pa.list_(pa.float64())), ("exits", pa.list_(_EXIT)),
])


def neighbour_frame(df: DataFrame, keys: list[str], order: str, hit: Column, reach: int) -> DataFrame:
    """Rows at most ``reach`` steps from a hit."""
    frame = Window.partitionBy(*keys).orderBy(order).rangeBetween(-reach, reach)
    return df.withColumn("__near", F.max(hit.cast("int")).over(frame)).filter("__near = 1").drop("__near")


def previous_header(df: DataFrame, keys: list[str], order: str, header: Column) -> DataFrame:
    """``df`` with the last header before each row."""
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("previous_header", F.last(F.when(header, F.col(order)), ignorenulls=True).over(before))


def merged_islands(df: DataFrame, keys: list[str], begin: str, end: str, gap: int | float = 1) -> DataFrame:
    """Intervals that overlap or lie within ``gap`` are one: begin, end and number. A group's intervals
    lie in as many tasks as they fill."""
    scan = Ranges(df, keys, [begin, end]).add(__reached=Running("max", F.col(end), before=True))
    fresh = F.when(F.col("__reached").isNull() | (F.col(begin) > F.col("__reached") + gap), 1).otherwise(0)
    marked = scan.add(__island=Running("sum", fresh)).result()
    return marked.groupBy(*keys, "__island").agg(F.min(begin).alias("island_begin"), F.max(end).alias("island_end"), F.count("*").alias("members")).drop("__island")


def trim_to_budget(df: DataFrame, keys: list[str], order: str, centre: str, size: str, budget: int) -> DataFrame:
    """Rows nearest to the centre while their sizes fit; the centre row always stays."""
    near = Window.partitionBy(*keys).orderBy(F.abs(F.col(order) - F.col(centre)), order).rowsBetween(Window.unboundedPreceding, 0)
    used = df.withColumn("__used", F.sum(size).over(near))
    return used.filter((F.col("__used") <= budget) | (F.col(order) == F.col(centre))).drop("__used")


def round_robin(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """``turn``: rows of turn 1 of all groups come before turn 2."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def stratified_sample(df: DataFrame, group: str, id_col: str, priority: Column, each: int) -> DataFrame:
    """Priority rows first, then by hash, ``each`` per group."""
    place = Window.partitionBy(group).orderBy(priority.cast("int").desc(), F.sha2(F.col(id_col).cast("string"), 256))
    return df.withColumn("sample_rank", F.row_number().over(place)).filter(F.col("sample_rank") <= each)


def unique_names(df: DataFrame, base: str, id_col: str) -> DataFrame:
    """``file_name``: the base, with the id where others have the same base."""
    n = F.row_number().over(Window.partitionBy(base).orderBy(id_col))
    return df.withColumn("file_name", F.when(n == 1, F.col(base)).otherwise(F.concat_ws("_", base, id_col)))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``active`` for the newest row of a key; the others are history."""
    return df.withColumn("active", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)


def within_budget(df: DataFrame, group: str, order: list[str], cost: str, cap: float) -> DataFrame:
    """Rows of each group whose running cost stays within the cap; a group may lie in many tasks."""
    return Ranges(df, [group], order).add(running_cost=Running("sum", F.col(cost))).result().filter(F.col("running_cost") <= cap)


class Limits(NamedTuple):
    rows: int
    size: float
    alone: float

    def add(self, rows: int, total: float, n: float) -> tuple[int, float] | None:
        """The open batch with one more row, or None if a new one has to begin. A row that goes
        alone leaves a full batch behind."""
        if rows and (rows >= self.rows or total + n > self.size or n > self.alone):
            return None
        return (self.rows if n > self.alone else rows + 1), total + n


def _filled(sizes: list[float], limits: Limits) -> tuple[list[int], int, float]:
    """Batch of every row if one begins at the first, and rows and size of the last batch."""
    batch, rows, total, out = 0, 0, 0.0, []
    for n in sizes:
        grown = limits.add(rows, total, n)
        if grown is None:
            batch, grown = batch + 1, limits.add(0, 0.0, n)
        rows, total = grown
        out.append(batch)
    return out, rows, total


def _segments(table: pa.Table) -> list[tuple[str, list[float]]]:
    """(key, sizes) of the runs of one group, in the order of the rows."""
    keys, sizes = table.column("__key").to_pylist(), table.column("__size").to_pylist()
    out: list[tuple[str, list[float]]] = []
    for key, n in zip(keys, sizes, strict=True):
        if not out or out[-1][0] != key:
            out.append((key, []))
        out[-1][1].append(n)
    return out


def _chained(parts: list, limits: Limits) -> dict[int, tuple[int, int]]:
    """part -> (rows that still belong to the batch before it, batches of its first group so far)."""
    begins, key, batches, rows, total = {}, None, 0, 0, 0.0
    for part in sorted(parts, key=lambda p: p["part"]):
        joins, at = part["first_key"] == key, 0
        if joins:
            for n in part["head"]:
                grown = limits.add(rows, total, n)
                if grown is None:
                    break
                (rows, total), at = grown, at + 1
        begins[part["part"]] = (at, batches if joins else 0)
        if joins and part["whole"]:
            if at < part["length"]:
                after = part["exits"][at]
                batches, rows, total = batches + after["begun"], after["rows"], after["total"]
        else:
            after = part["exits"][0]
            key, batches, rows, total = part["last_key"], after["begun"], after["rows"], after["total"]
    return begins


def bin_fill(df: DataFrame, group: str, order: str, size: str, most_rows: int, most_size: float, alone_over: float = float("inf")) -> DataFrame:
    """(group, order, batch): consecutive rows until a batch has enough rows or size; a row larger
    than ``alone_over`` is a batch of its own. A null size counts as 0.

    Rows are dealt by ranges of (group, order), so a large group lies in many tasks. A batch that
    is open where a range begins ends within ``most_rows`` rows. So each task tells how its range
    would end for each of those beginnings, the driver chains these few numbers per task, and
    tasks number their batches from there.
    """
    limits = Limits(most_rows, most_size, alone_over)
    work = Workspace(df.sparkSession, "bin-fill")
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("null"))
    dealt = df.select(group, order, key.alias("__key"), F.coalesce(F.col(size).cast("double"), F.lit(0.0)).alias("__size"))
    dealt = dealt.repartitionByRange(group, order).sortWithinPartitions(group, order)
    rows = work.keep(dealt.withColumn("__at", F.monotonically_increasing_id()), "rows")
    rows = rows.withColumn("__part", F.shiftright("__at", 33))

    def ends(table: pa.Table) -> pa.Table:
        part, segments = table.column("__part")[0].as_py(), _segments(table.sort_by("__at"))
        first, last = segments[0], segments[-1]
        whole, exits = len(segments) == 1, []
        for at in range(min(limits.rows, len(last[1])) if whole else 1):
            batches, n, total = _filled(last[1][at:], limits)
            exits.append({"begun": batches[-1] + 1, "rows": n, "total": total})
        row = {"part": part, "first_key": first[0], "last_key": last[0], "whole": whole, "length": len(first[1]), "head": first[1][: limits.rows], "exits": exits}
        return pa.Table.from_pylist([row], schema=_ENDS)

    ends_sql = "part long, first_key string, last_key string, whole boolean, length long, head array<double>, exits array<struct<begun: long, rows: long, total: double>>"
    begins = _chained(rows.groupBy("__part").applyInArrow(ends, ends_sql).collect(), limits)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def number(table: pa.Table) -> pa.Table:
        table = table.sort_by("__at")
        at, before = begins[table.column("__part")[0].as_py()]
        batches: list[int] = []
        for _, sizes in _segments(table):
            batches += [before - 1] * min(at, len(sizes)) + [before + b for b in _filled(sizes[at:], limits)[0]]
            at, before = 0, 0
        return table.select([group, order]).append_column("batch", pa.array(batches, pa.int32()))

    return rows.groupBy("__part").applyInArrow(number, f"{group} {kinds[group]}, {order} {kinds[order]}, batch int")


def ranked_soft_cap(df: DataFrame, group: str, order: list[str], size: str, most_rows: int, soft: float) -> DataFrame:
    """The best rows of a group: at most ``most_rows``, and none after the running size has
    passed ``soft``; the first always stays."""
    ranked = Ranges(df, [group], order).add(rank=Running("count"), before=Running("sum", F.col(size), before=True)).result()
    return ranked.filter((F.col("rank") == 1) | ((F.col("rank") <= most_rows) & (F.col("before") < soft)))


def heading_context(df: DataFrame, keys: list[str], order: str, header: Column, reach: int) -> DataFrame:
    """``headings``: places of the headers within ``reach`` of a row, and the one before those."""
    by = Window.partitionBy(*keys).orderBy(order)
    place = F.when(header, F.col(order))
    inside = F.collect_list(place).over(by.rangeBetween(-reach, reach))
    before = F.max(place).over(by.rangeBetween(Window.unboundedPreceding, -reach - 1))
    return df.withColumn("headings", F.array_sort(F.array_distinct(F.array_compact(F.concat(F.array(before), inside)))))


def first_of_each(df: DataFrame, category: str, order: list[Column], each: int) -> DataFrame:
    """The first rows of every category, for people to look at."""
    by = Window.partitionBy(category).orderBy(*order)
    return df.withColumn("sample_rank", F.row_number().over(by)).filter(F.col("sample_rank") <= each)


def smoke_selection(tasks: DataFrame, id_col: str, group: str, volume: str, busiest: int, each: int) -> DataFrame:
    """(id, picked_by): the tasks of greatest volume, then the first of every group among the rest."""
    top = tasks.orderBy(F.col(volume).desc(), id_col).limit(busiest).select(F.col(id_col), F.lit("volume").alias("picked_by"))
    rest = tasks.join(top.select(id_col), id_col, "left_anti")
    spread = first_of_each(rest, group, [F.col(volume).desc(), F.col(id_col)], each)
    return top.union(spread.select(id_col, F.lit("group")))
