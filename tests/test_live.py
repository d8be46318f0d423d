"""Live chains and the service that stands behind the live queries."""

from __future__ import annotations

import json

import pytest
from helpers import page, record

from metaingest.plans.inputs import LiveInputs
from metaingest.samples import transport
from metaingest.specs import ApiSpec, ProcessSpec

CHANGES = ApiSpec(
    base_url="http://h/register", anchor_indicator="more", anchor_element="cursor", record_tag="entry", key_tag="no"
)
SPEC = ProcessSpec(1, "stations", CHANGES, ApiSpec())


def chain(pages, missing=None):
    following = [f"http://p/{n + 1}" for n in range(pages - 1)] + [""]
    bodies = {f"http://p/{n}": page(record(n), "true" if url else "false", url) for n, url in enumerate(following)}
    bodies.pop(f"http://p/{missing}", None)
    return lambda url, headers: bodies[url]


def test_segments_of_a_live_chain_grow(spark):
    batches = list(LiveInputs(chain(40), segment_pages=2).page_batches(spark, SPEC, "http://p/0"))
    assert len(batches) <= 6
    assert [r.url for pages, _ in batches for r in pages.orderBy("page_no").collect()] == [f"http://p/{n}" for n in range(40)]
    assert batches[-1][1] is None


def test_a_failing_page_ends_a_segment_before_it(spark):
    batches = LiveInputs(chain(9, missing=5), segment_pages=100).page_batches(spark, SPEC, "http://p/0")
    pages, following = next(batches)
    assert (pages.count(), following) == (5, "http://p/5")
    with pytest.raises(Exception, match="p/5"):
        next(batches)


def test_records_of_one_file_are_fetched_on_all_cores(spark, tmp_path):
    spark.range(100).selectExpr("id", "map('id', cast(id as string)) as args").coalesce(1).write.parquet(f"{tmp_path}/m")
    inputs = LiveInputs(lambda url, headers: url)
    rows = inputs.add_payloads(spark.read.parquet(f"{tmp_path}/m"), ApiSpec(base_url="u"), 0)
    parts = rows.selectExpr("id", "data", "spark_partition_id() as part").collect()
    assert sorted((r.id, r.data) for r in parts) == [(n, f"u?id={n}") for n in range(100)]
    assert len({r.part for r in parts}) > 1


def test_service_reads_little_for_a_body(spark, tmp_path, monkeypatch):
    bodies = {f"http://s/{n}": "" if n % 50 == 0 else f"\n{n}é" * (n % 9 * 60) for n in range(3000)}
    frame = spark.createDataFrame(list(bodies.items()), "url string, body string")
    service = transport.publish(frame, f"{tmp_path}/service", 3)
    parsed = []
    monkeypatch.setattr(transport.json, "loads", lambda text, loads=json.loads: parsed.append(1) or loads(text))
    wanted = list(bodies)[::10]
    assert [service(url, {}) for url in wanted] == [bodies[url] for url in wanted]
    assert len(parsed) < 2 * len(wanted)
    with pytest.raises(transport.NotServed):
        service("http://s/none", {})
