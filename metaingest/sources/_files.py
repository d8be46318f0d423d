"""Append-only parquet folders with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import local_rows


LONG, INT, TEXT, TIME, FLAG = T.LongType(), T.IntegerType(), T.StringType(), T.TimestampNTZType(), T.BooleanType()


def schema_of(**columns: T.DataType) -> T.StructType:
    """Schema from ``name=type``, without needing a session."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def folder_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def append_row(spark: SparkSession, path: str, schema: T.StructType, row: tuple) -> None:
    local_rows(spark, schema, [row]).coalesce(1).write.mode("append").parquet(path)


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a folder; none if nothing was written to it yet."""
    if not folder_exists(spark, path):
        return local_rows(spark, schema)
    return spark.read.schema(schema).parquet(path)
