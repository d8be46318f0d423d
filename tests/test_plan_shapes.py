"""The physical plans are the ones meant for large data."""

from __future__ import annotations

import io
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metaingest.operators.explode import explode_records
from metaingest.operators.extract import check_values, parse_payloads
from metaingest.operators.fold import incoming_rows
from metaingest.operators.lookup import lookup_payloads
from metaingest.operators.upsert import upsert_rows
from metaingest.plans.apply import apply_snapshot
from metaingest.plans.workspace import Workspace
from metaingest.samples import data
from metaingest.session import settings

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df, mode="simple"):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def space(spark, tmp_path_factory):
    space = Workspace(spark, str(tmp_path_factory.mktemp("space")))
    parts = data.table(spark, SF_DIR, "part")
    space.archive.append(data.part_archive(parts, data.full_part_payload(), 1))
    space.archive.append(data.part_archive(parts, data.full_part_payload(), 2))
    apply_snapshot(space, data.PART_SPEC, 1, datetime(2024, 1, 1))
    return space


def test_one_parse_per_payload_even_under_a_filter(space):
    checked = check_values(parse_payloads(space.archive.read(1), data.PART_API), data.PART_API)
    assert plan_of(checked.where("reason is null")).count("ArrowEvalPython") == 1


def test_one_run_reads_one_folder_and_only_its_columns(space):
    plan = plan_of(space.archive.read(2).select("id", "data"))
    assert "PartitionFilters: [isnotnull(change_id" in plan
    assert "ReadSchema: struct<id:bigint,data:string>" in plan


def test_exploding_drops_the_array(spark):
    pages = data.manifest_pages(data.table(spark, SF_DIR, "part"))
    plan = plan_of(explode_records(pages, data.MANIFEST_API, data.PART_API))
    (generate,) = [line for line in plan.splitlines() if "Generate posexplode" in line]
    kept = generate.split("),")[1].split("]")[0]
    assert "_records" not in kept and "_bad_page" in kept


def test_fold_combines_before_the_shuffle(space):
    parsed = check_values(parse_payloads(space.archive.read(1), data.PART_API), data.PART_API)
    plan = plan_of(incoming_rows(parsed, data.PART_API.targets()[0]))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("partial_max_by")


def test_upsert_does_not_shuffle_the_target(spark, space):
    version = space.tables.current("product")
    (target,) = data.PART_API.targets()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1, spark__sql__shuffle__partitions=version.buckets + 3):
        parsed = check_values(parse_payloads(space.archive.read(2), data.PART_API), data.PART_API)
        placed = space.tables.layout(incoming_rows(parsed, target), target.key_names, version.buckets)
        rows = upsert_rows(
            space.tables.read_version(version), placed, target.key_names, target.value_names, F.lit(datetime(2024, 1, 2))
        )
        plan = plan_of(rows)
    stored, incoming = plan.split("FullOuter")[1].split("Exchange", 1)
    assert "Bucketed: true" in stored and "_metadata" in stored, plan
    assert "REPARTITION_BY_NUM" in incoming and "Bucketed: true" not in incoming, plan


def test_hot_lookup_key_is_split(spark):
    manifest = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, "1").otherwise(F.col("id").cast("string")).alias("key"), F.concat(F.lit("n" * 50), "id").alias("notification")
    )
    payloads = spark.range(60_000).select(F.col("id").cast("string").alias("key"), F.lit("p").alias("body"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__autoBroadcastJoinThreshold=-1,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        joined = lookup_payloads(manifest.repartition(8), payloads)
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        assert len(rows) == 60_000
        assert "skew=true" in plan_of(joined)


def test_each_bucket_is_one_file(spark, space):
    apply_snapshot(space, data.PART_SPEC, 2, datetime(2024, 1, 2))
    version = space.tables.current("product")
    assert version.number == 2 and all(len(names) == 1 for names in version.files.values())


def test_only_the_files_of_the_wanted_buckets_are_opened(spark, space):
    version = space.tables.current("product")
    (target,) = data.PART_API.targets()
    rows = space.tables.read_version(version, [3])
    rows.write.format("noop").mode("overwrite").save()
    found = rows.select("_metadata.file_name").distinct().collect()
    assert [r.file_name for r in found] == list(version.files[3])
    executed = rows._jdf.queryExecution().executedPlan()
    rows.collect()
    metrics = executed.collectLeaves().apply(0).metrics()
    assert metrics.apply("numFiles").value() == 1
    assert rows.where(space.tables.bucket_of(target.key_names, version.buckets) != 3).count() == 0
