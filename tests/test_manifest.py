"""Pages, chains and records."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import ROOT
from helpers import BASE, IN_USE, page, record

from pyspark.sql import functions as F

from metaingest import LandedInputs
from metaingest.functions import documents
from metaingest.functions.documents import register_functions
from metaingest.operators.explode import explode_records
from metaingest.plans.inputs import BROADCAST_KEY_BYTES
from metaingest.sources.pages import chain_positions, manifest_pages, next_links
from metaingest.sources.payloads import fetch_payloads
from metaingest.operators.lookup import ERROR_ENVELOPE, check_unique_keys, lookup_payloads
from metaingest.specs import ApiSpec

API = ApiSpec(
    base_url=BASE, anchor_indicator="more", anchor_element="cursor", anchor_args={"p": "1"}, record_tag="entry", key_tag="no"
)


def pages(spark, *bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_no bigint, body string")


def exploded(spark, api, *bodies):
    rows = explode_records(pages(spark, *bodies), api).orderBy("page_no", "record_no").collect()
    return [(r.page_no, r.record_no, r.key, r.reason) for r in rows]


def test_only_root_children_are_records(spark):
    body = page(record(1) + f"<deep>{record(9)}</deep>" + record(2) + "<other><no>3</no></other>")
    assert exploded(spark, API, body) == [(0, 0, "1", None), (0, 1, "2", None)]


def test_unusable_pages_and_keys_have_reasons(spark):
    keyless = "<entry><part>b</part></entry>"
    got = exploded(spark, API, "<broken", None, page(), page(keyless + record("") + record("x1") + record(" 7 ")))
    assert got == [
        (0, None, None, "page_not_a_document"),
        (1, None, None, "page_not_a_document"),
        (3, 0, None, "blank_key"),
        (3, 1, "", "blank_key"),
        (3, 2, "x1", "key_not_numeric"),
        (3, 3, " 7 ", None),
    ]


def test_blank_tags_select_nothing(spark):
    assert exploded(spark, ApiSpec(record_tag="", key_tag="no"), page(record(1))) == []
    assert exploded(spark, ApiSpec(record_tag="entry", key_tag=""), page(record(1))) == []


def test_response_filter_looks_at_one_record_at_a_time(spark):
    api = ApiSpec(record_tag="entry", key_tag="no", response_filter=IN_USE)
    body = page(record(1, "open") + record(2, "shut") + record(3, "trial") + "<entry><no>4</no></entry>")
    assert [r[2] for r in exploded(spark, api, body)] == ["1", "3"]


def test_json_pages(spark):
    api = ApiSpec(record_tag="entry", key_tag="no", content_type="JSON")
    array, single = '{"entry": [{"no": 1}, {"no": 2, "t": "<x>"}]}', '{"more": false, "entry": {"no": 5}}'
    assert [r[2] for r in exploded(spark, api, array, single, "[")] == ["1", "2", "5", None]


def test_request_arguments(spark):
    data_api = ApiSpec(
        base_url="u",
        request_args={"units": "metric", "no": "//entry/no", "b": "//part", "none": "//nothing", "x": "//part[string-length(.)>1]"},
    )
    body = page("<entry><no>1</no><part>b</part><part/><part>a&amp;c</part><part>b</part></entry>")
    args = explode_records(pages(spark, body), API, data_api).first()["args"]
    assert args == {"units": "metric", "no": "1", "b": "b,a&c", "x": "a&c"}


def test_arguments_of_unions_and_nested_texts(spark):
    data_api = ApiSpec(
        base_url="u",
        request_args={"u": "//a | //c", "n": "//a", "p": "//a[string-length(.)>1]", "v": "//a[string-length(.)>0] | //c"},
    )
    body = page("<entry><no>1</no><a>x<b>y</b></a><c>z</c></entry>")
    assert explode_records(pages(spark, body), API, data_api).first()["args"] == {"u": "xy,z", "n": "xy", "p": "xy", "v": "xy,z"}


def test_marks_of_whole_texts_are_not_seen_by_paths(spark):
    data_api = ApiSpec(
        base_url="u",
        request_args={"bare": "//a[not(@*)]/b/..", "any": "//a[@*[. = 'k']]/ancestor-or-self::a", "quoted": "//a[b = '@*']/b[1]/."},
    )
    body = page("<entry><no>1</no><a>x<b>y</b></a><a t='k'>p&amp;<b>@*</b></a></entry>")
    row = explode_records(pages(spark, body), API, data_api).first()
    assert row["args"] == {"bare": "xy", "any": "p&@*", "quoted": "@*"}
    assert "whole-text" not in row["notification"]


def test_records_of_a_page_in_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(documents, "CHUNK_CHARS", 1000)
    bodies = [page("".join(record(no, part="\u00e9\U0001f600" * 9) for no in range(n))) for n in (0, 1, 40, 3000)]
    rows = explode_records(pages(spark, *bodies, bodies[2][:-1], None), API).collect()
    for page_no, n in enumerate((0, 1, 40, 3000)):
        assert [(r.record_no, r.key) for r in rows if r.page_no == page_no] == [(no, str(no)) for no in range(n)]
    assert [(r.page_no, r.reason) for r in rows if r.reason] == [(4, "page_not_a_document"), (5, "page_not_a_document")]
    assert all("\u00e9\U0001f600" * 9 in r.notification for r in rows if r.notification)


def test_pages_that_declare_an_encoding_or_entities(spark):
    declared = '<?xml version="1.0" encoding="UTF-16"?>' + page("<entry><no>1</no><part>\u00e9</part></entry>")
    entity = '<!DOCTYPE r [<!ENTITY e "7">]><r><!-- c --><entry><no>&e;</no></entry>t<?p q?></r>'
    unknown = '<!DOCTYPE r SYSTEM "x"><r><entry><no>&nbsp;</no></entry></r>'
    rows = explode_records(pages(spark, declared, entity, unknown, "\ufeff" + page(record(2))), API).orderBy("page_no").collect()
    assert [(r.key, r.reason) for r in rows] == [("1", None), ("7", None), (None, "page_not_a_document"), ("2", None)]


def test_a_large_page_is_never_held_as_a_tree():
    one = "<entry><no>1</no>" + "<part>some text of a part</part>" * 30 + "</entry>"
    code = f"""
import resource, sys
import pyarrow as pa
sys.path.insert(0, {ROOT!r})
from metaingest.functions import _trees as trees
one = {one!r}
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
body = pa.array(["<r>" + one * (60_000_000 // len(one)) + "</r>"])[0]
held = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
count = sum(len(trees.xml_of(r)) == len(one) for r in trees.page_records(body, "entry", False))
assert count == 60_000_000 // len(one)
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - held) // 1024)
"""
    grown = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300)
    assert int(grown.stdout) < 20


def test_a_deep_record_keeps_its_text(spark):
    deep = "<d a='1'>" * 1500 + "t&amp;u" + "</d>" * 1500
    row = explode_records(pages(spark, page(f"<entry><no>1</no>{deep}</entry>")), API).first()
    assert row.reason is None and row.notification.count("<d a=") == 1500 and "t&amp;u</d>" in row.notification


def test_a_payload_landed_twice_needs_an_order(spark):
    manifest = spark.createDataFrame([("1", 1)], "key string, n int")
    payloads = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("2", "d")], "key string, body string")
    with pytest.raises(ValueError, match="landed more than once"):
        LandedInputs(payloads=payloads).add_payloads(manifest, API, 1)
    check_unique_keys(payloads, manifest.where("n > 1"))


def chain(spark, rows, start, api=API):
    landed = spark.createDataFrame(rows, "process_id bigint, url string, body string")
    starts = spark.createDataFrame([(1, start)], "process_id bigint, url string")
    links = next_links(landed, api)
    found = chain_positions(links, starts).join(landed, ["process_id", "url"]).collect()
    return [r.url for r in sorted(found, key=lambda r: r.page_no)]


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 8, 9, 13])
def test_chain_order_whatever_the_length(spark, length):
    urls = [f"http://h/{(7 * n) % 101}" for n in range(length)]
    rows = [(1, u, page(more="true", following=n)) for u, n in zip(urls, urls[1:])] + [(1, urls[-1], page())]
    rows += [(1, "http://h/decoy", page(more="true", following=urls[0])), (2, urls[0], page(more="true", following="http://h/2"))]
    assert chain(spark, rows[::-1], urls[0]) == urls


def test_chain_ends(spark):
    loop = [(1, "http://a", page(more="TRUE", following="http://b")), (1, "http://b", page(more="true", following="http://a"))]
    assert chain(spark, loop, "http://a") == ["http://a", "http://b"]
    blank = [(1, "http://a", page(more="true"))]
    assert chain(spark, blank, "http://a") == ["http://a"]
    relative = [(1, "http://a", page(more="true", following="&amp;x=1")), (1, f"{BASE}?p=1&x=1", page())]
    assert chain(spark, relative, "http://a") == ["http://a", f"{BASE}?p=1&x=1"]
    missing = [(1, "http://a", page(more="true", following="http://gone"))]
    assert chain(spark, missing, "http://a") == ["http://a"]
    assert chain(spark, relative, "http://a", ApiSpec(anchor_element="next")) == ["http://a"]
    assert chain(spark, missing, "http://nowhere") == []


def test_page_landed_twice_is_an_error(spark):
    with pytest.raises(ValueError, match="landed twice"):
        chain(spark, [(1, "http://a", page()), (1, "http://a", page())], "http://a")


def test_live_pages_follow_anchors(spark):
    bodies = {
        f"{BASE}?p=1": page(record(1), "true", "&amp;n=2"),
        f"{BASE}?p=1&n=2": page("", "true", "http://h/3"),
        "http://h/3": page(record(3), "true", "http://h/3"),
    }
    api = ApiSpec(**{**API.__dict__, "header_args": {"k": "v"}})

    def transport(url, headers):
        assert headers == {"k": "v"}
        return bodies[url]

    rows = manifest_pages(spark, transport, [(1, api, f"{BASE}?p=1"), (2, api, "http://h/3")]).collect()
    assert sorted((r.process_id, r.page_no, r.url) for r in rows) == [
        (1, 0, f"{BASE}?p=1"), (1, 1, f"{BASE}?p=1&n=2"), (1, 2, "http://h/3"), (2, 0, "http://h/3"),
    ]
    part = manifest_pages(spark, transport, [(1, api, f"{BASE}?p=1")], max_pages=2).orderBy("page_no").collect()
    assert [r.next_url for r in part] == [f"{BASE}?p=1&n=2", "http://h/3"]


def test_live_payloads_retry_and_fall_back(spark):
    manifest = spark.range(40).selectExpr("id", "map('id', cast(id as string)) as args")

    def transport(url, headers):
        if url.endswith("7"):
            raise RuntimeError("no transport error of the usual kind")
        return f"<ok>{url}</ok>"

    rows = fetch_payloads(manifest, ApiSpec(base_url="u"), transport, attempts=2).collect()
    assert len(rows) == 40
    for row in rows:
        assert row.data == (ERROR_ENVELOPE if row.id % 10 == 7 else f"<ok>u?id={row.id}</ok>")


def test_lookup_keeps_every_record(spark):
    manifest = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3), (None, 4)], "key string, n int")
    payloads = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), (None, "x", 1)], "key string, body string, seq int")
    rows = lookup_payloads(manifest, payloads, landed_order="seq").collect()
    assert sorted((r.n, r.data) for r in rows) == [(1, "new"), (2, "new"), (3, ERROR_ENVELOPE), (4, ERROR_ENVELOPE)]


def test_sql_functions(spark):
    register_functions(spark)
    spark.createDataFrame([(page(record(1) + record(2)),), ("<bad",)], "body string").createOrReplaceTempView("sql_pages")
    rows = spark.sql("SELECT r.* FROM sql_pages, LATERAL xml_records(body, 'entry', 'no') r").collect()
    assert sorted((r.position, r.key) for r in rows if r.key) == [(0, "1"), (1, "2")] and len(rows) == 3
    row = spark.sql("SELECT xml_text_at('<a><b>x</b></a>', '/a/b') t, xml_body_at('<a><b>x</b></a>', '/a/b') b").first()
    assert tuple(row) == ("x", "<b>x</b>")


def test_small_and_large_manifests_find_the_same_payloads(spark):
    manifest = spark.createDataFrame([("1", 1), ("1", 2), ("2", 3)], "key string, n int").withColumn("args", F.create_map())
    payloads = spark.createDataFrame([("1", "one"), ("3", "three")], "key string, body string")
    inputs = LandedInputs(payloads=payloads)
    found = [
        sorted((r.n, r.data) for r in inputs.add_payloads(manifest, API, size).collect()) for size in (1, BROADCAST_KEY_BYTES + 1)
    ]
    assert found[0] == found[1] == [(1, "one"), (2, "one"), (3, ERROR_ENVELOPE)]
