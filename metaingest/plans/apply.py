"""Apply: from archived payloads to typed target tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions._cols import field as sub
from ..functions._cols import named, quoted
from ..operators.extract import check_values, parse_payloads
from ..operators.fold import incoming_rows
from ..operators.upsert import (
    ACTION,
    ADDED_AT,
    INSERTED,
    UNCHANGED,
    UNTOUCHED,
    UPDATED,
    UPDATED_AT,
    action_counts,
    upsert_rows,
)
from ..session import spread, staged
from ..sources.tables import TableStore, Version
from ..specs import ProcessSpec, TargetSpec
from .workspace import Workspace

APPLY_STAGE = "apply"
ACTIONS = (INSERTED, UPDATED, UNCHANGED, UNTOUCHED)


class Applier(Protocol):
    """How folded rows reach a target table."""

    def apply(
        self, incoming: DataFrame, target: TargetSpec, now: Column, expected_rows: int, batch: tuple[str, int] | None = None
    ) -> dict[str, int]:
        """Write the rows; returns rows per action.

        ``batch`` names a stream and its batch: one that the table already has is
        not written again."""


class StoreApplier:
    """Default: a new version of a bucketed table that rewrites the touched buckets."""

    def __init__(self, tables: TableStore):
        self.tables = tables

    def apply(
        self, incoming: DataFrame, target: TargetSpec, now: Column, expected_rows: int, batch: tuple[str, int] | None = None
    ) -> dict[str, int]:
        with self.tables.writing(target.table):
            return self._apply(incoming, target, now, expected_rows, batch)

    def _apply(
        self, incoming: DataFrame, target: TargetSpec, now: Column, expected_rows: int, batch: tuple[str, int] | None
    ) -> dict[str, int]:
        tables, keys = self.tables, target.key_names
        version = tables.current(target.table)
        batches = {} if batch is None else {batch[0]: batch[1]}
        if version is not None and batch is not None and version.batches.get(batch[0], -1) >= batch[1]:
            return {}
        rows_so_far = version.rows if version else 0
        buckets = tables.bucket_count(rows_so_far + expected_rows, version)
        if version is None:
            # Nothing to meet: the rows need not be known before they are written.
            rows = upsert_rows(None, tables.layout(incoming, keys, buckets), keys, target.value_names, now)
            done, counted = _counted(rows)
            tables.write(target.table, counted, keys, buckets, lambda: done.get[INSERTED], None, None, batches)
            return {action: done.get[action] for action in ACTIONS}
        with staged(incoming, "incoming", touched=F.collect_set(tables.bucket_of(keys, buckets))) as (changes, seen):
            if not seen["rows"]:
                if batches:
                    tables.note_batches(version, batches)
                return {UNTOUCHED: version.rows}
            touched = sorted(seen["touched"])
            shares = version.has_layout(keys, buckets) and _types_stay(version, incoming)
            old = tables.read_version(version, touched if shares else None)
            rows = upsert_rows(old, tables.layout(changes, keys, buckets), keys, target.value_names, now)
            if not version.has_layout(keys, buckets):
                rows = tables.layout(rows, keys, buckets)
            done, counted = _counted(rows)
            tables.write(
                target.table, counted, keys, buckets, lambda: rows_so_far + done.get[INSERTED], version,
                touched if shares else None, batches,
            )
        counts = {action: done.get[action] for action in ACTIONS}
        return {**counts, UNTOUCHED: rows_so_far - counts[UPDATED] - counts[UNCHANGED]}


def _counted(rows: DataFrame) -> tuple[Observation, DataFrame]:
    """Upserted rows without their action, and the rows per action once they are written."""
    done = Observation()
    return done, rows.observe(done, *[F.count_if(F.col(ACTION) == a).alias(a) for a in ACTIONS]).drop(ACTION)


def _types_stay(version: Version, incoming: DataFrame) -> bool:
    """Files of the version can be read beside rows that come in."""
    known = {f.name: f.dataType for f in version.schema}
    return all(known.get(f.name, f.dataType) == f.dataType for f in incoming.schema)


class MergeApplier:
    """For catalogs whose tables support MERGE: only changed rows are sent.

    ``table_name`` maps a target table to its catalog name, whose parts are
    split by dots.
    """

    def __init__(self, table_name=lambda name: name):
        self.table_name = table_name

    def apply(
        self, incoming: DataFrame, target: TargetSpec, now: Column, expected_rows: int, batch: tuple[str, int] | None = None
    ) -> dict[str, int]:
        with staged(incoming, "incoming") as (changes, _):
            counts = self.counts(changes, target)
            self._merge(changes, target, now)
        return counts

    def counts(self, incoming: DataFrame, target: TargetSpec) -> dict[str, int]:
        """Rows per action that merging would give; reads the columns to compare only."""
        stored = incoming.sparkSession.table(self.table_name(target.table))
        columns = [*target.key_names, *target.value_names]
        old = stored.select(*map(named, columns)).withColumns(
            {c: F.lit(None).cast("timestamp_ntz") for c in (ADDED_AT, UPDATED_AT)}
        )
        rows = upsert_rows(old, incoming, target.key_names, target.value_names, F.lit(None).cast("timestamp_ntz"))
        return action_counts(rows).first().asDict()

    def _merge(self, incoming: DataFrame, target: TargetSpec, now: Column) -> None:
        name = self.table_name(target.table)
        prefix = ".".join(map(quoted, name.split(".")))
        source = incoming.alias("n")

        def stored(column: str) -> Column:
            return F.col(f"{prefix}.{quoted(column)}")

        matched = None
        for key in target.key_names:
            test = stored(key) == sub("n", key)
            matched = test if matched is None else matched & test

        def supplied(value: str) -> Column:
            return F.coalesce(F.col("n.present").getField(value), F.lit(False))

        differs = F.lit(False)
        for value in target.value_names:
            differs = differs | (supplied(value) & ~stored(value).eqNullSafe(sub("n", value)))
        updates = {
            value: F.when(supplied(value), sub("n", value)).otherwise(stored(value))
            for value in target.value_names
        }
        inserts = {c: sub("n", c) for c in target.key_names + target.value_names}
        (
            source.mergeInto(name, matched)
            .whenMatched(differs)
            .update({**updates, "upd_dtime": now})
            .whenNotMatched()
            .insert({**inserts, "add_dtime": now, "upd_dtime": now})
            .merge()
        )


@dataclass
class ApplyResult:
    """``cut`` counts usable records with a text longer than its column."""

    total: int = 0
    failed: int = 0
    cut: int = 0
    actions: dict[str, dict[str, int]] = field(default_factory=dict)
    problems: list[str] = field(default_factory=list)


def parse_run(archive: DataFrame, spec: ProcessSpec) -> DataFrame:
    """Flat records of archived payloads with a reason for each unusable one."""
    source = archive.select("change_id", "id", "ean", "data")
    return check_values(parse_payloads(source, spec.data_api), spec.data_api)


def apply_payloads(
    archive: DataFrame,
    workspace: Workspace,
    spec: ProcessSpec,
    now: datetime,
    applier: Applier | None = None,
    change_id: int | None = None,
    batch: tuple[str, int] | None = None,
) -> ApplyResult:
    """Parse archived payloads once, set bad ones aside, upsert the rest.

    The parsed values are staged as columns: each target table then reads only
    its own, and the bodies are read a single time.
    """
    stamp = F.lit(now).cast("timestamp_ntz")
    applier = applier or StoreApplier(workspace.tables)
    cut = F.count_if(F.col("reason").isNull() & (F.size("truncated") > 0))
    with staged(parse_run(archive, spec), "parsed", failed=F.count("reason"), cut=cut) as (parsed, seen):
        total, failed = seen["rows"], seen["failed"]
        result = ApplyResult(total, failed, seen["cut"], problems=spec.data_api.problems())
        if failed:
            set_aside(parsed, workspace, now, change_id)
        for target in spec.data_api.targets() if total > failed else ():
            once = {} if batch is None else {"batch": batch}
            counts = applier.apply(incoming_rows(parsed, target), target, stamp, total - failed, **once)
            known = result.actions.setdefault(target.table, dict.fromkeys(ACTIONS, 0))
            for action, count in counts.items():
                known[action] += count
    return result


def set_aside(parsed: DataFrame, workspace: Workspace, now: datetime, change_id: int | None = None) -> None:
    """Send unusable records to quarantine; they keep their archive row."""
    bad = parsed.where(F.col("reason").isNotNull())
    rows = bad.select("change_id", "id", F.col("ean").cast("string").alias("key"), "reason", "detail")
    workspace.quarantine.append(rows, APPLY_STAGE, F.lit(now).cast("timestamp_ntz"), change_id)


def apply_snapshot(
    workspace: Workspace, spec: ProcessSpec, change_id: int, now: datetime, applier: Applier | None = None
) -> ApplyResult:
    """Apply what one run archived."""
    archive = workspace.archive.read(change_id)
    return apply_payloads(spread(archive, "id"), workspace, spec, now, applier, change_id)
