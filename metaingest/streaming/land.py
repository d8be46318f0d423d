"""Continuous pull: pages to the archive, resumed by checkpoint.

Pages come from landed files, or from a live manifest whose stream offset is the
anchor of the next page. A batch that runs again after a failure gets the page
numbers of its first attempt, so records that this one archived are not added twice.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.explode import explode_records
from ..plans.pull import archive_records, page_span, total_records
from ..plans.workspace import Workspace
from ..sources.page_stream import page_stream
from ..sources.pages import Transport, plain_url
from ..specs import ProcessSpec

LANDED_PAGE_SCHEMA = "process_id bigint, page_no bigint, url string, body string"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream's checkpoint keeps over restarts; a new checkpoint has a new one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def stream_archive(
    spark: SparkSession,
    pages_path: str,
    workspace: Workspace,
    spec: ProcessSpec,
    inputs,
    change_id: int,
    now: datetime,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Archive the records of page files as they land, under an open run.

    The checkpoint is the resume point; ``finish_run`` ends the run. Page numbers
    must not repeat within a batch.
    """
    pages = (
        spark.readStream.schema(LANDED_PAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(pages_path)
        .where(F.col("process_id") == spec.process_id)
    )
    return _archive(spark, pages, workspace, spec, inputs, change_id, now, checkpoint)


def stream_pull(
    spark: SparkSession,
    transport: Transport,
    workspace: Workspace,
    spec: ProcessSpec,
    inputs,
    change_id: int,
    now: datetime,
    checkpoint: str,
    start_url: str | None = None,
    segment_pages: int = 100,
) -> StreamingQuery:
    """Follow a live manifest from ``start_url`` (the configured request) on, under an open run.

    A batch is one segment of the chain. After it is archived the ledger notes the
    anchor that follows, so that a pull without this checkpoint can go on there too.
    """
    start = start_url or plain_url(spec.change_api.base_url, spec.change_api.request_args)
    pages = page_stream(spark, transport, spec.process_id, spec.change_api, start, segment_pages)
    return _archive(spark, pages, workspace, spec, inputs, change_id, now, checkpoint)


def _archive(spark, pages: DataFrame, workspace: Workspace, spec: ProcessSpec, inputs, change_id: int, now: datetime, checkpoint: str) -> StreamingQuery:
    def archive_batch(batch: DataFrame, batch_id: int) -> None:
        try:
            first, count = page_span(batch)
            if not count:
                return
            this = (stream_id(spark, checkpoint), batch_id)
            end, again = workspace.ledger.reserve_batch(change_id, spec.process_id, now, count, this)
            live = "next_url" in batch.columns
            # A segment of a chain is walked in one piece; its records are found on all cores.
            pieces = batch.repartition(spark.sparkContext.defaultParallelism, "page_no") if live else batch
            records = explode_records(pieces, spec.change_api, spec.data_api)
            archive_records(workspace, spec, change_id, records, end - first, now, inputs, again)
            if live:
                following = batch.agg(F.max_by("next_url", "page_no")).first()[0]
                workspace.ledger.save_anchor(change_id, spec.process_id, now, following or "")
        finally:
            batch.unpersist()

    return (
        pages.writeStream.foreachBatch(archive_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish_run(query: StreamingQuery, workspace: Workspace, spec: ProcessSpec, change_id: int, now: datetime) -> int:
    """Wait for a stream's end and complete its run with the number of its records.

    A stream that fails fails the run, which keeps its anchor, and raises."""
    try:
        query.awaitTermination()
    except Exception as error:
        state = workspace.ledger.state().where(F.col("change_id") == change_id).first()
        workspace.ledger.fail(change_id, spec.process_id, now, (state and state["last_anchor"]) or "", str(error))
        raise
    total = total_records(workspace, change_id)
    workspace.ledger.complete(change_id, spec.process_id, now, total)
    return total
