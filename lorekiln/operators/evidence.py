"""Evidence: layers, duplicates, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lorekiln.functions import text as T

def evidence_layer(rejected: dict[str, Column], review: dict[str, Column]) -> tuple[Column, Column]:
    """(layer, reasons): rejected if any rule of the first kind holds, review by the second."""
    no, maybe = T.flags(**rejected), T.flags(**review)
    layer = F.when(F.size(no) > 0, "rejected").when(F.size(maybe) > 0, "review").otherwise("valid")
    return layer, F.array_sort(F.array_union(no, maybe))


def first_of_equals(df: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """The first id of equal keys with the number of rows it stands for."""
    return df.groupBy(*keys).agg(F.min(id_col).alias(id_col), F.count("*").alias("duplicates"))


def coverage(tags: DataFrame, tag: str, parts: dict[str, DataFrame]) -> DataFrame:
    """Every tag with its number of rows in each part; tags without any have zeros."""
    out = tags.select(tag).distinct()
    for name, part in parts.items():
        out = out.join(part.groupBy(tag).agg(F.count("*").alias(f"{name}_count")), tag, "left").withColumn(f"{name}_count", F.coalesce(f"{name}_count", F.lit(0)))
    return out
