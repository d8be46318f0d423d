"""Payload landings: the newest one counts, and bodies stay where they lie."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from metaingest.operators.lookup import ERROR_ENVELOPE, check_unique_keys
from metaingest.plans.inputs import LandedInputs
from metaingest.session import settings
from metaingest.sources.payload_store import TABLE, PayloadStore
from metaingest.specs import ApiSpec


def rows(spark, pairs):
    return spark.createDataFrame(pairs, "key string, body string")


def found(store, wanted):
    return {r.key: r.body for r in store.newest(wanted).collect()}


def test_the_newest_landing_counts(spark, tmp_path):
    store = PayloadStore(spark, str(tmp_path))
    wanted = spark.createDataFrame([("1",), ("1",), ("2",), ("4",), (None,)], "key string")
    assert found(store, wanted) == {}
    assert store.land(rows(spark, [("1", "a"), ("2", "b"), ("3", "c")])) == 1
    assert store.land(rows(spark, [("2", "B"), ("5", None)])) == 2
    assert found(store, wanted) == {"1": "a", "2": "B"}
    assert store.land(rows(spark, [])) == 3
    store.spread_out(32)
    again = PayloadStore(spark, str(tmp_path))
    assert again.land(rows(spark, [("1", "A")])) == 5
    assert found(again, wanted) == {"1": "A", "2": "B"} and again.tables.current(TABLE).buckets == 32
    assert found(again, spark.createDataFrame([("5",)], "key string")) == {"5": None}


def test_a_key_landed_twice_at_once_is_refused(spark, tmp_path):
    store = PayloadStore(spark, str(tmp_path))
    with pytest.raises(ValueError, match="more than once"):
        store.land(rows(spark, [("1", "a"), ("1", "b")]))
    assert store.tables.current(TABLE) is None


def test_landed_inputs_take_a_store(spark, tmp_path):
    store = PayloadStore(spark, str(tmp_path))
    store.land(rows(spark, [("1", "a")]))
    manifest = spark.createDataFrame([("1", "x"), ("1", "y"), ("2", "z")], "key string, notification string")
    manifest = manifest.withColumn("args", F.create_map().cast("map<string,string>"))
    got = LandedInputs(payloads=store).add_payloads(manifest, ApiSpec(), 10).collect()
    assert sorted((r.key, r.notification, r.data) for r in got) == [("1", "x", "a"), ("1", "y", "a"), ("2", "z", ERROR_ENVELOPE)]


def test_bodies_are_not_shuffled(spark, tmp_path):
    store = PayloadStore(spark, str(tmp_path))
    store.land(spark.range(2000).select(F.col("id").cast("string").alias("key"), F.repeat(F.lit("b"), 50).alias("body")))
    wanted = spark.range(0, 2000, 7).select(F.col("id").cast("string").alias("key"))
    out = io.StringIO()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1), redirect_stdout(out):
        store.newest(wanted).explain()
    lines = out.getvalue().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line]
    assert len(scans) == 2, out.getvalue()
    for scan in scans:
        above, level = [], depth[scan]
        for i in range(scan - 1, 0, -1):
            if depth[i] < level:
                above.append(lines[i])
                level = depth[i]
        assert not [line for line in above if "Exchange" in line], out.getvalue()
    narrow = [lines[i] for i in scans if "body" not in lines[i].split("ReadSchema:")[1].split(">")[0]]
    assert len(narrow) == 1
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=-1):
        assert store.newest(wanted).count() == 286


def test_only_wanted_keys_are_checked(spark):
    payloads = rows(spark, [("1", "a"), ("2", "b"), ("2", "c")])
    check_unique_keys(payloads, spark.createDataFrame([("1",)], "key string"))
    with pytest.raises(ValueError, match=": 2"):
        check_unique_keys(payloads, spark.createDataFrame([("2",)], "key string"))
