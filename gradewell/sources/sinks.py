"""Sinks: stored tables and views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Store as Parquet, replacing what is there, and read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, buckets: int, key: str) -> DataFrame:
    """Store as a catalogue table in ``buckets`` of ``key``, sorted by it; rows should come in as many partitions of it."""
    df.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def create_bucketed_parts(
    spark: SparkSession, name: str, schema: StructType, path: str, part: str, buckets: int, key: str
) -> None:
    """Create a catalogue table over a folder, by ``part`` and in ``buckets`` of ``key``; it sees the parts written through it."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({part}) "
        f"CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )


def create_or_replace_table(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace a catalogue table whose files lie in ``path``."""
    df.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def create_view(df: DataFrame, name: str) -> DataFrame:
    """Create or replace a session view; nothing is computed."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def drop_view(spark: SparkSession, name: str) -> None:
    spark.catalog.dropTempView(name)
