"""Pull: from a change manifest or a key list to archived payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import minilang as ml
from ..functions import times, urls
from ..functions.typed import numeric_key
from ..operators.explode import PAGE_NOT_DOCUMENT, explode_records
from ..operators.specs import has_keys, key_frame
from ..session import local_rows, staged, work_partitions
from ..sources.archive import archive_id
from ..sources.pages import plain_url
from ..specs import ApiSpec, ProcessSpec, SpecError
from .workspace import Workspace

PULL_STAGE = "pull"
KEY_PAGES = 4096
KEY_OVERHEAD = 64


def manifest_for_keys(keys: DataFrame, change_api: ApiSpec, data_api: ApiSpec) -> DataFrame:
    """Manifest records made up for listed keys, in the form of exploded ones.

    Keys are hashed into pages and numbered inside each, which gives ids
    without a global sort; a key list promises no order.
    """
    record_tag, key_tag = change_api.record_tag or "record", change_api.key_tag or "key"
    key_api = ApiSpec(record_tag=record_tag, key_tag=key_tag)
    page_no = F.pmod(F.xxhash64("key"), F.lit(KEY_PAGES))
    paged = keys.where(~ml.is_blank("key")).select("key", page_no.alias("page_no"))
    numbered = paged.repartition(work_partitions(keys.sparkSession), "page_no").withColumn(
        "_place", F.row_number().over(Window.partitionBy("page_no").orderBy("key")) - 1
    )
    body = F.concat(F.lit("<root>"), urls.key_manifest(F.col("key"), record_tag, key_tag), F.lit("</root>"))
    records = explode_records(numbered.select("page_no", "_place", body.alias("body")), key_api, data_api)
    return records.withColumn("record_no", F.col("_place")).drop("_place")


def request_window(workspace: Workspace, spec: ProcessSpec, now: datetime) -> tuple[ApiSpec, str | None]:
    """Change API with its lower bound set, and an anchor to resume from instead."""
    api = spec.change_api
    if not api.since_arg:
        return api, None
    now_col = F.lit(now).cast("timestamp_ntz")
    start, anchor = workspace.ledger.next_start(spec.process_id, now_col)
    if anchor:
        return api, anchor
    configured = api.request_args.get(api.since_arg)
    question = local_rows(
        workspace.spark, "since string, start timestamp_ntz, now timestamp_ntz", [(configured, start, now)]
    )
    millis = question.select(times.since_millis("since", "start", F.col("now"))).first()[0]
    return (api if millis is None else api.with_request_arg(api.since_arg, str(millis))), None


def archive_records(
    workspace: Workspace, spec: ProcessSpec, change_id: int, manifest: DataFrame, base: int, now: datetime, inputs, again: bool = False
) -> None:
    """Archive one batch of manifest records with their payloads.

    ``again``: an earlier attempt may have archived some of them under the same ids.

    The records are staged first: pages are parsed once, the lookup knows how
    large its keys are, and unusable records go to quarantine from there.
    """
    stamp = F.lit(now).cast("timestamp_ntz")
    numbered = manifest.select(
        archive_id(F.col("page_no") + F.lit(base), F.coalesce("record_no", F.lit(0))).alias("id"),
        "key",
        "notification",
        "args",
        "reason",
    )
    metrics = {"bad": F.count("reason"), "key_bytes": F.sum(F.octet_length("key"))}
    with staged(numbered, "manifest", **metrics) as (records, seen):
        good = records.where(F.col("reason").isNull()).drop("reason")
        key_bytes = (seen["key_bytes"] or 0) + KEY_OVERHEAD * seen["rows"]
        rows = inputs.add_payloads(good, spec.data_api, key_bytes).select(
            "id",
            numeric_key("key").alias("ean"),
            "notification",
            "data",
            stamp.alias("add_dtime"),
            stamp.alias("upd_dtime"),
            F.lit(change_id).cast("bigint").alias("change_id"),
        )
        workspace.archive.append(rows, change_id, again)
        if seen["bad"]:
            bad = records.where(F.col("reason").isNotNull()).withColumn("change_id", F.lit(change_id))
            workspace.quarantine.append(bad, PULL_STAGE, stamp, change_id)


def total_records(workspace: Workspace, change_id: int) -> int:
    """Records of a run, usable or not, over all of its attempts."""
    archived = workspace.archive.read(change_id).count()
    set_aside = (
        workspace.quarantine.read(change_id)
        .where((F.col("stage") == PULL_STAGE) & (F.col("reason") != PAGE_NOT_DOCUMENT))
        .count()
    )
    return archived + set_aside


def pull(spark: SparkSession, workspace: Workspace, spec: ProcessSpec, inputs, now: datetime) -> int:
    """Archive what changed for one process; returns the run's change id.

    A blank change URL means a key list. Otherwise an unfinished run is
    resumed at its anchor, or a new run starts with an incremental window.
    A failure is recorded in the ledger before it is raised.
    """
    ledger, process_id = workspace.ledger, spec.process_id
    anchor = ""
    if not spec.change_api.base_url.strip():
        return _pull_keys(spark, workspace, spec, inputs, now)
    resumed = ledger.resume_point(process_id)
    if resumed is not None:
        change_id, anchor = resumed["change_id"], resumed["last_anchor"] or ""
    else:
        change_id = ledger.open_run(process_id, now)
    try:
        api = spec.change_api
        if not anchor:
            api, found = request_window(workspace, spec, now)
            anchor = found or ""
        start_url = anchor or plain_url(api.base_url, api.request_args)
        for pages, following in inputs.page_batches(spark, spec, start_url):
            first, count = page_span(pages)
            base = ledger.reserve_pages(change_id, process_id, now, count) - first
            archive_records(
                workspace, spec, change_id, explode_records(pages, api, spec.data_api), base, now, inputs
            )
            if following:
                anchor = following
                ledger.save_anchor(change_id, process_id, now, following)
    except Exception as error:
        ledger.fail(change_id, process_id, now, anchor, str(error))
        raise
    ledger.complete(change_id, process_id, now, total_records(workspace, change_id))
    return change_id


def _pull_keys(spark, workspace: Workspace, spec: ProcessSpec, inputs, now: datetime) -> int:
    if not has_keys(spark, spec.change_api, inputs.key_table):
        raise SpecError(f"process {spec.process_id} has neither a change URL nor keys")
    keys = key_frame(spark, spec.change_api, inputs.key_table)
    ledger, process_id = workspace.ledger, spec.process_id
    change_id = ledger.open_run(process_id, now)
    try:
        base = ledger.reserve_pages(change_id, process_id, now, KEY_PAGES)
        manifest = manifest_for_keys(keys, spec.change_api, spec.data_api)
        archive_records(workspace, spec, change_id, manifest, base, now, inputs)
    except Exception as error:
        ledger.fail(change_id, process_id, now, "", str(error))
        raise
    ledger.complete(change_id, process_id, now, total_records(workspace, change_id))
    return change_id


def page_span(pages: DataFrame) -> tuple[int, int]:
    """First page number and how many there are; numbers make up the archive ids, so none may repeat."""
    low, high, rows, numbers = pages.agg(
        F.min("page_no"), F.max("page_no"), F.count("page_no"), F.count_distinct("page_no")
    ).first()
    if rows != numbers:
        raise ValueError(f"{rows} pages have {numbers} numbers")
    return (0, 0) if low is None else (low, high - low + 1)
