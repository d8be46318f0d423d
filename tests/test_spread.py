"""Steps that take no detour and use all cores."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from metaingest import ApiSpec, Workspace
from metaingest.functions import _trees as trees
from metaingest.functions.documents import record_chunks
from metaingest.functions.paths import is_tree_filter
from metaingest.operators.explode import explode_records
from metaingest.operators.specs import has_keys
from metaingest.plans import apply
from metaingest.plans.inputs import LandedInputs
from metaingest.plans.pull import manifest_for_keys
from metaingest.samples import data
from metaingest.session import work_partitions


def test_first_version_is_written_without_staging(spark, tmp_path, monkeypatch):
    labels = []
    monkeypatch.setattr(apply, "staged", lambda df, label, staged=apply.staged, **m: labels.append(label) or staged(df, label, **m))
    space = Workspace(spark, str(tmp_path))
    rows = [(n, f"p{n}", n % 5, n * 1.5) for n in range(40)]
    parts = spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int, p_retailprice double")
    for change_id, some in ((1, parts.where("p_partkey < 30")), (2, parts.where("p_partkey >= 20"))):
        space.archive.append(data.part_archive(some, data.full_part_payload(), change_id), change_id)
        result = apply.apply_snapshot(space, data.PART_SPEC, change_id, datetime(2024, 1, change_id))
        assert result.actions["product"] == (
            {"inserted": 30, "updated": 0, "unchanged": 0, "untouched": 0}
            if change_id == 1
            else {"inserted": 10, "updated": 0, "unchanged": 10, "untouched": 20}
        )
    assert space.tables.read("product").count() == space.tables.current("product").rows == 40
    assert labels == ["parsed", "parsed", "incoming"]


def test_short_pages_are_parsed_together():
    """As each on its own, but for the parsers."""
    good = [f"<root><r><k>{n}</k> &amp; <b/></r>tail<s/><r a='{n}'><k/></r></root>" for n in range(150)]
    odd = ["<root>", None, "", "<root/>", "</x><x>", "<root xmlns:p='u'><p:r/><r/></root>", "<!-- c --><root><r/></root>", "<root/><root/>"]
    for some in (good, good[:70] + odd + good[70:], odd):
        bodies = pa.array(some, pa.string())
        for tag in ("r", None, "*", "."):
            found = list(trees.records_of_pages(bodies, tag, False))
            alone = [trees.page_records(body, tag, False) for body in bodies]
            assert [r and [trees.xml_of(e) for e in r] for r in found] == [r and [trees.xml_of(e) for e in r] for r in alone]


def test_short_pages_share_parsers(monkeypatch):
    parses = []
    monkeypatch.setattr(trees, "page_records", lambda *page: parses.append(page))
    bodies = pa.array([f"<root><r><k>{n}</k></r></root>" for n in range(150)], pa.string())
    assert [len(list(records)) for records in trees.records_of_pages(bodies, "r", False)] == [1] * 150
    assert not parses


def test_listed_keys_use_all_cores(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("key")).distinct()
    records = manifest_for_keys(keys, ApiSpec(record_tag="product", key_tag="ean"), ApiSpec())
    filled = records.select(F.spark_partition_id().alias("part")).distinct().count()
    assert filled == work_partitions(spark) > spark.sparkContext.defaultParallelism


def test_looking_for_keys_reads_no_more_than_one(spark):
    """A row beyond the first keys can't be read: looking must not come to it."""
    unreadable = F.when(F.col("id") > 50, F.raise_error(F.lit("read on"))).otherwise(F.col("id"))
    source = spark.range(0, 100, 1, 4).select(unreadable.cast("bigint").alias("ean"))
    api = ApiSpec(key_list="wanted_parts", key_tag="ean")
    assert has_keys(spark, api, lambda _name: source)
    assert not has_keys(spark, api, lambda _name: spark.range(3).select(F.lit(None).cast("bigint").alias("ean")))
    assert has_keys(spark, ApiSpec(key_list=" , 7")) and not has_keys(spark, ApiSpec(key_list=" ,")) and not has_keys(spark, ApiSpec())


def test_plain_records_are_written_as_by_tostring(monkeypatch):
    bodies = [
        "<r a='&lt;&amp;&quot;&#10;' b=\"'&gt;\"> x &amp; &lt; &gt; &#13;\n<k/>t&amp;<m>\U0001f600</m></r>", "<r/>", "<r> </r>", "<r><k></k>tail</r>",
        "<r xmlns='u'/>", "<r xmlns:p='u'><p:k/></r>", "<r><k xml:lang='de'>x</k></r>", "<r xmlns:p='u' p:a='1'/>",
    ]
    expected = [trees.ET.tostring(trees.ET.fromstring(body), encoding="unicode") for body in bodies]
    assert [trees.xml_of(trees.ET.fromstring(body)) for body in bodies] == expected
    monkeypatch.setattr(trees.ET, "tostring", None)
    assert [trees.xml_of(trees.ET.fromstring(body)) for body in bodies[:4]] == expected[:4]


FILTERS = [
    "//k[. != 'x']", "//k[.='x']", "/r/k", "//*[ k != 'x' ]/m", "/r[k='x'][m != \"y\"]", "//r//m", "k", "//k[2]", "//k[. = 'x' or . = 'y']",
    "//k/@a", "//m[. != '']",
]


def test_the_parse_tells_what_the_filter_selects(spark):
    """As XPath over each record does, which is left to ask where the parse has not told."""
    inner = ["", "<k>x</k>", "<k>y</k>", "<k/>", "<k>x</k><k a='1'>y<m/>x</k>", "<m><k>x</k><m>y</m></m>", "<k>x</k><m>y</m>", "<k>&#13;x</k>", "<p:k>y</p:k>"]
    body = "<root xmlns:p='u'>" + "".join(f"<r><id>{n}</id>{text}</r>" for n, text in enumerate(inner)) + "</root>"
    pages = spark.createDataFrame([(body,)], "body string")
    for path in FILTERS:
        api = ApiSpec(record_tag="r", key_tag="id", response_filter=path)
        every = explode_records(pages, ApiSpec(record_tag="r", key_tag="id"))
        expected = every.where(F.xpath_boolean("notification", F.lit(path)))
        assert [r.key for r in explode_records(pages, api).orderBy("record_no").collect()] == [
            r.key for r in expected.orderBy("record_no").collect()
        ], path
        chunks = record_chunks(pages, "body", "r", "id", "XML", filter_path=path)
        (told,) = chunks.select("_records.passes").collect()
        known = is_tree_filter(path)
        assert [p is not None for p in told.passes] == [known] * (len(inner) - 1) + [False]


def test_each_of_few_pages_has_a_task_of_its_own(spark):
    """They were merged by size, to one task for all pages of a chain."""
    parts = spark.range(350).select(
        F.col("id").alias("p_partkey"), F.lit(1).alias("p_size"), F.lit("t").alias("p_type"), F.lit("b").alias("p_brand")
    )
    pages = data.manifest_pages(parts).select("process_id", "url", "body")
    ((dealt, following),) = LandedInputs(pages).page_batches(spark, data.PART_SPEC, f"{data.BASE_URL}?list=spares")
    records = explode_records(dealt, data.MANIFEST_API)
    tasks = [row.task for row in records.select("page_no", F.spark_partition_id().alias("task")).distinct().collect()]
    assert len(tasks) == len(set(tasks)) == 7 and following is None


def test_links_of_a_long_page_take_no_tree(monkeypatch):
    """The texts of a page's own elements, with the long way of reading and the short one."""
    pages = [
        "<root><more>true</more><r><cursor>0</cursor></r><cursor>a<b>c</b>&amp;</cursor><cursor>2</cursor></root>", "<root><r/></root>",
        "<root><cursor/><r/>x<more>false</more></root>", "<root><more>true</more><cursor>1</cursor>", "no page", "",
        "<?xml version='1.0' encoding='latin-1'?><root><r>\u20ac</r><more> \u20ac</more></root>", "<root xmlns='u'><more>true</more></root>", None,
    ]
    bodies = pa.array(pages, pa.string())
    for tags in (["more", "cursor"], ["more", ""], ["", ""], ["r", "r"], ["*", "cursor"]):
        short = [trees.root_texts(body, tags, False) for body in bodies]
        with monkeypatch.context() as patch:
            patch.setattr(trees, "_PAGE_BYTES", -1)
            if "*" not in tags:
                patch.setattr(trees, "parse_document", None)
            assert [trees.root_texts(body, tags, False) for body in bodies] == short
    assert [trees.root_texts(bodies[i], ["more", "cursor"], False) for i in (0, 1, 3)] == [["true", "ac&"], [None, None], None]
