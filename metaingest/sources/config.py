"""Configuration tables from wherever they are kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CONFIG_TABLES = ("cfg_process", "cfg_api", "cfg_bucket")


def read_config(
    spark: SparkSession, root: str | None = None, file_format: str = "parquet", names=CONFIG_TABLES, **options: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The process, API and bucket tables, in that order.

    With ``root`` they are folders or files below it; with format ``jdbc``
    they are database tables (``options`` hold url and driver); else they are
    catalog tables.
    """
    if file_format == "jdbc":
        frames = [spark.read.format("jdbc").options(dbtable=name, **options).load() for name in names]
    elif root is not None:
        frames = [spark.read.format(file_format).options(**options).load(f"{root.rstrip('/')}/{name}") for name in names]
    else:
        frames = [spark.table(name) for name in names]
    return tuple(frames)
