"""Tables handed from one step to the next, as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonalis.session import stage_path


def write_stage(df: DataFrame, path: str, *partition_by: str) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh path in the shared folder and read back: computed once, however often it is used."""
    path = stage_path(df.sparkSession, name)
    write_stage(df, path)
    return read_stage(df.sparkSession, path)
