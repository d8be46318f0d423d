"""Continuous apply: newly archived payloads to the target tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.apply import Applier, apply_payloads
from ..plans.workspace import Workspace
from ..sources.archive import ARCHIVE_SCHEMA
from ..specs import ProcessSpec
from .land import stream_id


def stream_apply(
    spark: SparkSession,
    workspace: Workspace,
    spec: ProcessSpec,
    now: datetime,
    checkpoint: str,
    applier: Applier | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Upsert archived payloads of a process's runs in batches of new files.

    A table's version log notes the last batch it has in the append that publishes
    it, so a batch that runs again after a failure is brought to those tables only
    that do not have it. The ledger counts what each batch applied; a completed run
    of which every record was is noted as applied.
    """
    mark_applied(workspace, spec, now)
    archived = (
        spark.readStream.schema(ARCHIVE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(workspace.archive.path)
    )

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        runs = workspace.ledger.state().where(F.col("process_id") == spec.process_id).select("change_id")
        mine = batch.join(runs, "change_id", "left_semi")
        this = (stream_id(spark, checkpoint), batch_id)
        apply_payloads(mine, workspace, spec, now, applier, batch=this)
        for row in mine.groupBy("change_id").count().collect():
            workspace.ledger.batch_applied(row["change_id"], spec.process_id, now, this, row["count"])
        mark_applied(workspace, spec, now)

    return (
        archived.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def mark_applied(workspace: Workspace, spec: ProcessSpec, now: datetime) -> None:
    """Note the completed runs of which streams have applied every archived record."""
    for change_id, records in workspace.ledger.applied_by_streams(spec.process_id).items():
        if records >= workspace.archive.read(change_id).count():
            workspace.ledger.applied(change_id, spec.process_id, now)
