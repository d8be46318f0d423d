"""Session helpers: scratch space, staged results and scoped settings."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CHECKPOINT_DIR = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as the cluster names it.

    Only a local session without the setting gets a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="metaingest-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that nothing else uses."""
    return f"{scratch_root(spark)}/metaingest/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once and read it back: later readers prune columns,
    repeat no work, and lost executors cost nothing."""
    return stage_counted(df, label)[0]


def stage_counted(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict[str, object]]:
    """``stage``, with aggregates of the frame taken while it is written."""
    return _write_and_read(df, scratch_path(df.sparkSession, label), metrics)


def _write_and_read(df: DataFrame, path: str, metrics: dict[str, Column]) -> tuple[DataFrame, dict[str, object]]:
    seen = Observation()
    metrics = {"rows": F.count(F.lit(1)), **metrics}
    df.observe(seen, *[metric.alias(name) for name, metric in metrics.items()]).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


@contextmanager
def staged(df: DataFrame, label: str, **metrics: Column):
    """``stage_counted`` for the duration of a block; its files go afterwards."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _write_and_read(df, path, metrics)
    finally:
        jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jvm_path, True)


def local_rows(spark: SparkSession, schema: T.StructType | str, rows: list[tuple] = ()) -> DataFrame:
    """A few rows made on the driver, without the job a list of rows costs."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema)


def spread(scan: DataFrame, *keys: str) -> DataFrame:
    """Spread a plain file scan over all cores before costly per-row work.

    A scan of large data already has more splits than cores and is left as it
    is; only an input of few splits pays for an exchange. ``scan`` must not
    hold a shuffle, since asking for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, *keys)


TASKS_PER_CORE = 4


def work_partitions(spark: SparkSession) -> int:
    """Partitions for costly per-row work on rows that are small: named in an exchange,
    they are not merged to few tasks by size, as those of a join or aggregate are. Each
    starts Python, so there are some for each core and not one for every shuffle partition."""
    return TASKS_PER_CORE * spark.sparkContext.defaultParallelism


def dealt(rows: DataFrame, number: str) -> DataFrame:
    """Rows dealt out one after the other by a number that they have, before costly
    per-row work: few large rows, such as pages, never meet in a task. Takes an exchange."""
    parts = work_partitions(rows.sparkSession)
    return rows.repartitionById(parts, F.pmod(F.col(number), F.lit(parts)).cast("int"))


@contextmanager
def settings(spark: SparkSession, **values: object):
    """Set configuration for the duration of a block (dots written as ``__``)."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
