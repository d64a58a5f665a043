"""Readers and writers of the stages' files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_documents_csv(spark: SparkSession, path: str) -> DataFrame:
    """name, description, content: header, quoted line breaks, cells of any length."""
    schema = "name string, description string, content string"
    options = {"header": True, "multiLine": True, "escape": '"', "maxCharsPerColumn": -1, "enforceSchema": False}
    return spark.read.options(**options).schema(schema).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings."""
    return spark.read.options(header=True, multiLine=True, escape='"').csv(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict: a line that is no object of the schema fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_permissive(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, invalid lines with their reason)."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    value = F.try_parse_json("value")
    parsed = lines.select("value", F.when(value.isNull(), "invalid_json").when(~F.schema_of_variant(value).startswith("OBJECT"), "record_not_object").alias("reason"))
    records = parsed.filter("reason is null").select(F.from_json("value", schema).alias("r")).select("r.*")
    return records, parsed.filter("reason is not null").select("reason", F.col("value").alias("line"))


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, or no rows where the path doesn't exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return read_jsonl(spark, path, schema)
    return spark.createDataFrame([], schema)


def _flat(df: DataFrame) -> DataFrame:
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select([F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """Fixed columns; nested cells as JSON."""
    _flat(df).write.mode("overwrite").options(header=True, escape='"').csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_by_type(df: DataFrame, path: str, type_col: str) -> None:
    """A folder per type, as JSON lines."""
    df.write.mode("overwrite").partitionBy(type_col).json(path)
