"""Running numbers over ordered groups that may be large: one prefix scan for all of them.

Rows are sorted by ranges of (group, order), so that a large group lies in many tasks. Each task
works out its own running numbers and what a group comes to in it; the part of a group that is in
earlier tasks is one row per task, added up and joined back. No task sees a whole group.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lorekiln.sources.shared import Workspace

AT, PART = "__at", "__part"


@dataclass(frozen=True)
class Running:
    """``count``, ``sum`` or ``max`` of ``value`` over the rows of a group up to each row, or up to the
    one before it. Sums and counts begin with 0, a maximum with null."""

    kind: str
    value: Column | None = None
    before: bool = False

    def over(self, own: Column, frame) -> Column:
        made = {"count": F.count(F.lit(1)), "sum": F.sum(own), "max": F.max(own)}[self.kind]
        return made if frame is None else made.over(frame)

    def joined(self, carried: Column, local: Column) -> Column:
        if self.kind == "max":
            return F.greatest(carried, local)
        return F.coalesce(carried, F.lit(0)) + F.coalesce(local, F.lit(0))


class Ranges:
    """Rows of ``df`` in order of (keys, order), by ranges. Ties keep the order that the rows have."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str | Column]):
        self.keys, self.work, self.step = keys, Workspace(df.sparkSession, "ranges"), 0
        by = [*keys, *order, "__spread"]
        dealt = df.withColumn("__spread", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("__spread")
        self.rows = self._kept(dealt.withColumn(AT, F.monotonically_increasing_id()).withColumn(PART, F.shiftright(AT, 33)))

    def _kept(self, rows: DataFrame) -> DataFrame:
        self.step += 1
        return self.work.keep(rows, f"rows-{self.step}")

    def add(self, **runs: Running) -> Ranges:
        """One more column for each of ``runs``."""
        rows = self.rows
        for name, run in runs.items():
            rows = rows.withColumn(f"__own_{name}", F.lit(None) if run.value is None else run.value)
        sums = [run.over(F.col(f"__own_{name}"), None).alias(f"__sum_{name}") for name, run in runs.items()]
        totals = rows.groupBy(*self.keys, PART).agg(*sums)
        earlier = Window.partitionBy(*self.keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        carries = [(F.max if run.kind == "max" else F.sum)(f"__sum_{name}").over(earlier).alias(f"__carry_{name}") for name, run in runs.items()]
        begun = F.row_number().over(Window.partitionBy(*self.keys).orderBy(PART)) > 1
        carried = totals.select(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(self.keys)], F.col(PART).alias("__of"), *carries, begun.alias("__begun"))
        carried = self.work.keep(carried.filter("__begun").drop("__begun"), f"carried-{self.step}")
        for name, run in runs.items():
            frame = Window.partitionBy(*self.keys, PART).orderBy(AT).rowsBetween(Window.unboundedPreceding, -1 if run.before else 0)
            rows = rows.withColumn(f"__run_{name}", run.over(F.col(f"__own_{name}"), frame))
        meets = F.col(PART) == F.col("__of")
        for i, key in enumerate(self.keys):
            meets = meets & F.col(key).eqNullSafe(F.col(f"__key_{i}"))
        rows = rows.join(F.broadcast(carried), meets, "left")  # a row per range at most
        for name, run in runs.items():
            rows = rows.withColumn(name, run.joined(F.col(f"__carry_{name}"), F.col(f"__run_{name}")))
        self.rows = self._kept(rows.select(*self.rows.columns, *runs))
        self.work.drop(f"rows-{self.step - 1}")
        return self

    def result(self) -> DataFrame:
        return self.rows.drop(AT, PART)
