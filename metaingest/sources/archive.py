"""Raw archive and quarantine: append-only tables partitioned by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._files import LONG, TEXT, TIME, read_folder, schema_of

ARCHIVE_SCHEMA = schema_of(
    id=LONG, ean=LONG, notification=TEXT, data=TEXT, add_dtime=TIME, upd_dtime=TIME, change_id=LONG
)
QUARANTINE_SCHEMA = schema_of(
    stage=TEXT, id=LONG, key=TEXT, reason=TEXT, detail=TEXT, notification=TEXT, add_dtime=TIME, change_id=LONG
)

# A page body is below 2^31 bytes and a record takes at least 4 of them, so
# 29 bits hold any record position; 34 bits remain for the page sequence.
RECORD_BITS = 29


def archive_id(page_seq: Column, record_no: Column) -> Column:
    """Id that is unique and ascends in arrival order, without a global sort.

    ``page_seq`` is reserved in the ledger before the write, so a repeated
    attempt never reuses a number.
    """
    return F.shiftleft(page_seq.cast("bigint"), RECORD_BITS) + record_no.cast("bigint")


def _append(rows: DataFrame, path: str, change_id: int | None) -> None:
    if change_id is None:
        rows.write.mode("append").partitionBy("change_id").parquet(path)
    else:
        rows.drop("change_id").write.mode("append").parquet(f"{path}/change_id={change_id}")


class Archive:
    """Raw bodies of every run: ``<root>/archive``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/archive"

    def append(self, rows: DataFrame, change_id: int | None = None, again: bool = False) -> None:
        """Add rows; with ``change_id`` all are of that run, else each is of its own.

        A run so given writes to its own folder only, so that several may write at the
        same time. ``again``: rows whose ids the run has already are left out.
        """
        rows = rows.select(*ARCHIVE_SCHEMA.names)
        if again:
            rows = rows.join(self.read(change_id).select("id"), "id", "left_anti").select(*ARCHIVE_SCHEMA.names)
        _append(rows, self.path, change_id)

    def read(self, change_id: int | None = None) -> DataFrame:
        """Rows of one run (only its folder is read) or of all runs."""
        rows = read_folder(self.spark, self.path, ARCHIVE_SCHEMA)
        return rows if change_id is None else rows.where(F.col("change_id") == change_id)


class Quarantine:
    """Rows that could not be used, and why: ``<root>/quarantine``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/quarantine"

    def append(self, rows: DataFrame, stage: str, now: Column, change_id: int | None = None) -> None:
        """Add rows of one stage; rows already set aside are not added again.

        With ``change_id`` all rows are of that run, and only its folder is read.
        """
        have = set(rows.columns)
        fixed = {"stage": F.lit(stage), "add_dtime": now}
        columns = [
            (fixed.get(f.name, F.col(f.name) if f.name in have else F.lit(None))).cast(f.dataType).alias(f.name)
            for f in QUARANTINE_SCHEMA
        ]
        known = self.read(change_id).where(F.col("stage") == stage).select("change_id", "id")
        fresh = rows.select(*columns).join(known, ["change_id", "id"], "left_anti").select(*QUARANTINE_SCHEMA.names)
        _append(fresh, self.path, change_id)

    def read(self, change_id: int | None = None) -> DataFrame:
        rows = read_folder(self.spark, self.path, QUARANTINE_SCHEMA)
        return rows if change_id is None else rows.where(F.col("change_id") == change_id)
