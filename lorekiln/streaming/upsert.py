"""Latest-wins tables that grow by micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lorekiln.operators.windows import latest


def append_batches(stream: DataFrame, path: str, checkpoint: str):
    """Writes each micro-batch below its own number: a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def active_rows(spark: SparkSession, path: str, keys: list[str], order: str) -> DataFrame:
    """The newest row of each key over all batches."""
    rows = latest(spark.read.parquet(path), keys, [F.col(order).desc(), F.col("batch").desc()])
    return rows.filter("active").drop("active", "batch")
