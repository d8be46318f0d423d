"""One full run: every active process, pull then apply."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ..operators.specs import load_specs
from ..specs import ProcessSpec
from .apply import Applier, ApplyResult, apply_snapshot
from .pull import pull
from .workspace import Workspace

log = logging.getLogger(__name__)


@dataclass
class ProcessResult:
    process_id: int
    change_id: int | None = None
    applied: ApplyResult | None = None
    error: str | None = None


def run(
    spark: SparkSession,
    cfg_process: DataFrame,
    cfg_api: DataFrame,
    cfg_bucket: DataFrame,
    root: str,
    inputs,
    now: datetime,
    applier: Applier | None = None,
    parallel: int = 1,
) -> list[ProcessResult]:
    """Run all active processes; a failing one does not stop the others.

    ``parallel`` of them run at a time, in id order for 1. Each thread has a ledger
    of its own, whose commit numbers keep ids apart; processes that write one table
    take turns at it. Jobs carry the process's name as their group, and its scheduler
    pool where the application schedules fairly. After the pull every completed run of the process that was not applied yet is
    applied, oldest first, so a run whose apply failed is made up for later.
    """
    specs, skipped = load_specs(spark, cfg_process, cfg_api, cfg_bucket)
    results = [ProcessResult(process_id, error=reason) for process_id, reason in skipped.items()]
    if parallel == 1:
        workspace = Workspace(spark, root)
        results += [_run_process(spark, workspace, spec, inputs, now, applier) for spec in specs]
    else:

        def in_thread(spec: ProcessSpec) -> ProcessResult:
            context = spark.sparkContext
            context.setJobGroup(f"process-{spec.process_id}", spec.name or f"process {spec.process_id}")
            context.setLocalProperty("spark.scheduler.pool", f"process-{spec.process_id}")
            return _run_process(spark, Workspace(spark, root), spec, inputs, now, applier)

        with ThreadPoolExecutor(parallel, "process") as pool:
            results += pool.map(in_thread, specs)
    return sorted(results, key=lambda r: r.process_id)


def _run_process(
    spark: SparkSession, workspace: Workspace, spec: ProcessSpec, inputs, now: datetime, applier: Applier | None
) -> ProcessResult:
    result = ProcessResult(spec.process_id)
    try:
        result.change_id = pull(spark, workspace, spec, inputs, now)
    except Exception as error:
        log.exception("pull of process %s failed", spec.process_id)
        result.error = str(error)
    try:
        for change_id in workspace.ledger.unapplied(spec.process_id):
            result.applied = apply_snapshot(workspace, spec, change_id, now, applier)
            workspace.ledger.applied(change_id, spec.process_id, now)
    except Exception as error:
        log.exception("apply of process %s failed", spec.process_id)
        result.error = result.error or str(error)
    return result
