"""Stored tables: parameterised SQL, key scans, creation (rows I-5 to I-7)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_sql(spark: SparkSession, query: str, params: dict[str, Any] | None = None,
             **views: DataFrame) -> DataFrame:
    """SQL text with bound parameters over DataFrames; ``{name}`` in the text names a frame."""
    return spark.sql(query, args=params or {}, **views)


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str, lower: Any,
              upper: Any, partitions: int, **options: str) -> DataFrame:
    """External table read in parallel ranges; filters and columns are pushed to the source."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=partition_column,
                 lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions),
                 **options)
        .load()
    )


def existing_keys(stored: DataFrame, key: str, *more: str) -> DataFrame:
    """Key column of a stored table; column pruning keeps the scan to what is named."""
    return stored.where(F.col(key).isNotNull()).select(key, *more)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_table(spark: SparkSession, name: str, schema: T.StructType, path: str,
                 partition_by: list[str]) -> bool:
    """Create an external Parquet table with a fixed schema; False when it already exists."""
    if table_exists(spark, name):
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        + (f"PARTITIONED BY ({parts}) " if parts else "")
        + f"LOCATION '{path}'"
    )
    return True


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table that may not have been written yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
