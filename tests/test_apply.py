"""Extraction, folding, upserts and the table store."""

from __future__ import annotations

import os
import random
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from metaingest.operators.extract import check_values, parse_payloads
from metaingest.operators.fold import incoming_rows, last_writer_wins
from metaingest.operators.upsert import upsert_rows
from metaingest.plans.apply import MergeApplier, apply_snapshot, parse_run
from metaingest.plans.workspace import Workspace
from metaingest.sources import tables
from metaingest.specs import ApiSpec, BucketSpec, ColumnSpec, ProcessSpec, SpecError

MAIN = BucketSpec(
    "main",
    "product",
    (
        ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
        ColumnSpec("title", "//main/title", "Varchar2", 10),
        ColumnSpec("size", "//main/size", "Int32"),
    ),
)
PRICE = BucketSpec(
    "price", "product", (ColumnSpec("ean", "//main/ean", "Int64", is_key=True), ColumnSpec("price", "//main/price", "Double"))
)
API = ApiSpec(buckets=(MAIN, PRICE))
SPEC = ProcessSpec(1, "p", ApiSpec(), API)
NOW, LATER = datetime(2024, 1, 1), datetime(2024, 1, 2)


def doc(ean=None, **parts):
    inner = "".join(f"<{k}>{v}</{k}>" for k, v in {"ean": ean, **parts}.items() if v is not None)
    return f"<product><main>{inner}</main></product>"


def archive(spark, bodies, start=1, change_id=1):
    rows = [(n, n, "", body, NOW, NOW, change_id) for n, body in enumerate(bodies, start)]
    return spark.createDataFrame(
        rows,
        "id bigint, ean bigint, notification string, data string, add_dtime timestamp_ntz, upd_dtime timestamp_ntz, change_id bigint",
    )


def reasons(spark, bodies, api=API):
    checked = check_values(parse_payloads(archive(spark, bodies), api), api)
    return [(r.reason, r.detail) for r in checked.orderBy("id").collect()]


def test_reasons(spark):
    bodies = [
        doc(1, title="a"),
        "<response><errors/></response><errors>",
        "no xml",
        None,
        "",
        doc(1),
        "<product><other/></product>",
        doc(1, title="a", size="x", price="y"),
        doc("", title="a"),
        doc(None, title="a", size="1"),
        doc("abc", title="a"),
        doc(1, title="", price=""),
        doc(1, title="t", price="1e400"),
    ]
    assert reasons(spark, bodies) == [
        (None, None),
        ("error_payload", None),
        ("not_a_document", None),
        ("not_a_document", None),
        ("not_a_document", None),
        ("too_few_attributes", None),
        ("too_few_attributes", None),
        ("bad_value", "size,price"),
        ("blank_target_key", "ean"),
        ("blank_target_key", "ean"),
        ("bad_value", "ean"),
        (None, None),
        ("bad_value", "price"),
    ]


def test_shared_attribute_takes_the_last_bucket_that_has_it(spark):
    api = ApiSpec(
        buckets=(
            BucketSpec("a", "t", (ColumnSpec("k", "//k", "Int64", is_key=True), ColumnSpec("v", "//a"))),
            BucketSpec("b", "t", (ColumnSpec("k", "//k", "Int64", is_key=True), ColumnSpec("v", "//b[. = 'x' or . = '']"))),
            BucketSpec("none"),
        )
    )
    bodies = ["<r><k>1</k><a>1</a><b>x</b></r>", "<r><k>1</k><a>1</a></r>", "<r><k>1</k><a>1</a><b/></r>", "<r><k>1</k><a>1</a><b>q</b></r>"]
    rows = parse_payloads(archive(spark, bodies), api).orderBy("id").collect()
    assert [r.attrs.v for r in rows] == ["x", "1", "", "1"]


def test_two_types_for_one_column_are_rejected():
    clash = BucketSpec("other", "product", (ColumnSpec("ean", "//e", "Varchar2", is_key=True), ColumnSpec("x", "//x")))
    with pytest.raises(SpecError):
        ApiSpec(buckets=(MAIN, clash)).targets()
    with pytest.raises(SpecError):
        ApiSpec(buckets=(MAIN, BucketSpec("c", "product", (ColumnSpec("EAN", "//e"),)))).slots()


def test_fold_keeps_absent_and_empty_apart(spark):
    bodies = [doc("007", title="old", size="1"), doc(7, title="", size="2", price="2.5"), doc(7, size="3"), doc(7, title="", price="2.5")]
    parsed = check_values(parse_payloads(archive(spark, bodies), API), API)
    (target,) = API.targets()
    (row,) = incoming_rows(parsed, target).collect()
    assert (row.ean, row.title, row["size"], float(row.price)) == (7, None, 3, 2.5)
    assert all(row.present)
    (row,) = incoming_rows(parsed, target, absent="null").collect()
    assert (row.title, row["size"], float(row.price)) == (None, None, 2.5)


def test_fold_of_a_hot_key(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id", F.when(F.col("id") < 150_000, F.col("id").cast("string")).alias("v")
    )
    folded = last_writer_wins(rows, ["k"], ["v"], "id")
    hot = folded.where("k = 0").first()
    assert hot.v == "149997" and folded.count() == rows.select("k").distinct().count()


class Model:
    """The reading of an upsert that a dictionary gives."""

    def __init__(self):
        self.rows, self.added, self.moved = {}, {}, {}

    def apply(self, records, now):
        before = {k: dict(v) for k, v in self.rows.items()}
        for record in records:
            present_main = any(record.get(c) for c in ("title", "size"))
            present_price = bool(record.get("price"))
            if not (present_main or present_price):
                continue
            key = int(record["ean"])
            row = self.rows.setdefault(key, {"title": None, "size": None, "price": None})
            self.added.setdefault(key, now)
            self.moved.setdefault(key, now)
            for column, applies in (("title", present_main), ("size", present_main), ("price", present_price)):
                if applies and column in record:
                    row[column] = record[column] or None
        for key, row in self.rows.items():
            if key in before and self.typed(before[key]) != self.typed(row):
                self.moved[key] = now

    @staticmethod
    def typed(row):
        return (
            row["title"],
            None if row["size"] is None else int(row["size"]),
            None if row["price"] is None else float(row["price"]),
        )

    def table(self):
        return sorted((k, *self.typed(r), self.added[k], self.moved[k]) for k, r in self.rows.items())


def target_rows(space):
    rows = space.tables.read("product").collect()
    return sorted(
        (r.ean, r.title, r["size"], None if r.price is None else float(r.price), r.add_dtime, r.upd_dtime) for r in rows
    ) if rows else []


@pytest.mark.parametrize("seed", range(2))
def test_random_snapshots_match_a_dictionary(spark, tmp_path, seed):
    rng = random.Random(seed)
    space, model = Workspace(spark, str(tmp_path)), Model()

    def some():
        record = {"ean": rng.choice(["1", "02", "3", "4", "5", "006", "7"])}
        for name, values in (("title", ["a", "b", ""]), ("size", ["1", "01", "2", ""]), ("price", ["1.0", "1", "2.5", ""])):
            if rng.random() < 0.6:
                record[name] = rng.choice(values)
        return record

    for change_id in range(1, 4):
        records = [some() for _ in range(12)]
        records = [r for r in records if len(r) > 1]
        now = datetime(2024, 1, change_id)
        space.archive.append(archive(spark, [doc(**r) for r in records], change_id=change_id))
        result = apply_snapshot(space, SPEC, change_id, now)
        model.apply(records, now)
        assert result.failed == 0 and result.total == len(records)
        key = lambda row: tuple((v is None, str(v)) for v in row)
        assert sorted(target_rows(space), key=key) == sorted(model.table(), key=key)


def test_applying_twice_changes_nothing(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.archive.append(archive(spark, [doc(1, title="a", price="2"), doc(2, size="x"), doc(3, title="c")]))
    first = apply_snapshot(space, SPEC, 1, NOW)
    rows = target_rows(space)
    again = apply_snapshot(space, SPEC, 1, LATER)
    assert target_rows(space) == rows
    assert first.actions["product"]["inserted"] == 2 and again.actions["product"]["unchanged"] == 2
    assert space.quarantine.read().count() == 1
    # A new session-less reader finds the same table through its log.
    assert sorted(r.ean for r in Workspace(spark, str(tmp_path)).tables.read("product").collect()) == [1, 3]


def test_upsert_keeps_other_columns_and_adds_new_ones(spark):
    stamp = F.lit(NOW).cast("timestamp_ntz")
    target = spark.createDataFrame([(1, "x", 5), (2, "y", 6)], "k int, extra string, a int").select(
        "*", stamp.alias("add_dtime"), stamp.alias("upd_dtime")
    )
    incoming = spark.createDataFrame([(2, 7), (3, 8)], "k int, b int").withColumn("present", F.struct(F.lit(True).alias("b")))
    rows = upsert_rows(target, incoming, ["k"], ["b"], F.lit(LATER).cast("timestamp_ntz")).orderBy("k").collect()
    assert [(r.k, r.b, r.extra, r.a, r.action) for r in rows] == [
        (1, None, "x", 5, "untouched"), (2, 7, "y", 6, "updated"), (3, 8, None, None, "inserted"),
    ]


def test_tables_grow_their_buckets(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.tables.rows_per_bucket = 2
    for change_id, keys in ((1, range(3)), (2, range(100))):
        space.archive.append(archive(spark, [doc(k, title=f"t{k}") for k in keys], change_id=change_id))
        apply_snapshot(space, SPEC, change_id, NOW)
    assert space.tables.current("product").buckets == 64
    assert [r[0] for r in target_rows(space)] == list(range(100))


def test_half_written_version_is_never_read(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.archive.append(archive(spark, [doc(1, title="a")]))
    apply_snapshot(space, SPEC, 1, NOW)
    boom = F.raise_error(F.lit("lost"))
    broken = space.tables.read("product").withColumn("title", F.when(F.col("ean") == 1, boom))
    with pytest.raises(Exception, match="lost"):
        space.tables.write("product", broken, ["ean"], 8, lambda: 0, space.tables.current("product"))
    assert space.tables.current("product").number == 1
    assert [r[1] for r in target_rows(space)] == ["a"]


def test_vacuum_keeps_the_newest_versions(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    for n in (1, 2, 3):
        space.archive.append(archive(spark, [doc(n, title="t")], start=n, change_id=n))
        apply_snapshot(space, SPEC, n, NOW)
    written = sum(len(names) for names in space.tables.current("product").files.values())
    assert space.tables.vacuum("product", keep=3) == 0
    assert space.tables.vacuum("product") in (0, 1) and space.tables.vacuum("product") == 0
    assert sorted(r.ean for r in space.tables.read("product").collect()) == [1, 2, 3]
    space.tables.vacuum("product", keep=1)
    left = [f for f in os.listdir(space.tables.current("product").path) if f.endswith(".parquet")]
    assert len(left) == written
    assert sorted(r.ean for r in space.tables.read("product").collect()) == [1, 2, 3]


def paths_of(version):
    return {bucket: [f"{version.path}/{name}" for name in names] for bucket, names in version.files.items()}


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.archive.append(archive(spark, [doc(k, title=f"t{k}", price="1") for k in range(400)]))
    apply_snapshot(space, SPEC, 1, NOW)
    first = space.tables.current("product")
    bucket = space.tables.bucket_of(["ean"], first.buckets)
    mine = [r.ean for r in spark.range(400).select(F.col("id").alias("ean")).where(bucket == 2).collect()]
    assert len(mine) > 3
    space.archive.append(archive(spark, [doc(k, title="new") for k in mine[:3]], start=1000, change_id=2))
    result = apply_snapshot(space, SPEC, 2, LATER)
    second = space.tables.current("product")
    before, after = paths_of(first), paths_of(second)
    assert [b for b in before if before[b] != after[b]] == [2] and set(before) == set(after)
    assert len(after[2]) == 1 and second.rows == 400
    counts = result.actions["product"]
    assert (counts["updated"], counts["inserted"], counts["untouched"]) == (3, 0, 397)
    rows = {r.ean: (r.title, r.upd_dtime) for r in space.tables.read("product").collect()}
    assert len(rows) == 400 and rows[mine[0]] == ("new", LATER) and rows[mine[3]] == (f"t{mine[3]}", NOW)
    # Earlier versions stay readable, and the log lists rewritten buckets only.
    assert {r.title for r in space.tables.read_version(first, [2]).collect()} == {f"t{k}" for k in mine}
    entry = spark.read.parquet(f"{space.tables.log_path}/product").where("version = 2").first()
    assert not entry.lists_all and list(entry.files) == [2]


def test_many_versions_fold_to_one_list(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "VERSIONS_PER_LIST", 3)
    space = Workspace(spark, str(tmp_path))
    for n in range(1, 6):
        space.archive.append(archive(spark, [doc(n, title="t")], start=n, change_id=n))
        apply_snapshot(space, SPEC, n, NOW)
    version = space.tables.current("product")
    assert version.number == 5 and version.rows == 5
    log = {r.version: r.lists_all for r in spark.read.parquet(f"{space.tables.log_path}/product").collect()}
    assert log == {1: True, 2: False, 3: True, 4: False, 5: False}
    assert sorted(r.ean for r in Workspace(spark, str(tmp_path)).tables.read("product").collect()) == list(range(1, 6))


def test_a_new_column_leaves_old_files_in_place(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.archive.append(archive(spark, [doc(k, title="t", price="2") for k in range(50)]))
    narrow = ProcessSpec(1, "p", SPEC.change_api, replace(SPEC.data_api, buckets=SPEC.data_api.buckets[:1]))
    apply_snapshot(space, narrow, 1, NOW)
    first = space.tables.current("product")
    assert "price" not in first.schema.names
    space.archive.append(archive(spark, [doc(1, title="t", price="3")], start=1000, change_id=2))
    apply_snapshot(space, SPEC, 2, LATER)
    second = space.tables.current("product")
    assert second.path == first.path and sum(first.files[b] != second.files[b] for b in first.files) == 1
    rows = {r.ean: r.price for r in space.tables.read("product").collect()}
    assert len(rows) == 50 and float(rows[1]) == 3 and rows[2] is None


def test_a_failed_write_leaves_files_that_no_version_names(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    space.archive.append(archive(spark, [doc(k, title="a") for k in range(30)]))
    apply_snapshot(space, SPEC, 1, NOW)
    version = space.tables.current("product")
    rows = space.tables.read_version(version, [1])

    def lost():
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError, match="driver lost"):
        space.tables.write("product", rows, ["ean"], version.buckets, lost, version, [1])
    assert len(target_rows(space)) == 30
    assert space.tables.vacuum("product") == 1 and len(target_rows(space)) == 30


def test_merge_counts(spark, tmp_path):
    stamp = [F.lit(NOW).cast("timestamp_ntz").alias(c) for c in ("add_dtime", "upd_dtime")]
    stored = spark.createDataFrame([(1, "a", 1, None), (2, "b", 2, None), (3, "c", 3, None)], "ean bigint, title string, size int, price decimal(38,10)")
    stored.select("*", *stamp).write.mode("overwrite").saveAsTable("counted_product")
    records = archive(spark, [doc(1, title="a"), doc(2, title="x"), doc(9, title="new")])
    incoming = incoming_rows(parse_run(records, SPEC), SPEC.data_api.targets()[0])
    counts = MergeApplier(lambda name: "counted_" + name).counts(incoming, SPEC.data_api.targets()[0])
    assert counts == {"inserted": 1, "updated": 1, "unchanged": 1, "untouched": 1}


def test_pluggable_applier(spark, tmp_path):
    space, seen = Workspace(spark, str(tmp_path)), []

    class Collecting:
        def apply(self, incoming, target, now, expected_rows):
            seen.append((target.table, incoming.count(), expected_rows))
            return {"inserted": 1}

    space.archive.append(archive(spark, [doc(1, title="a"), doc(1, title="b")]))
    result = apply_snapshot(space, SPEC, 1, NOW, Collecting())
    assert seen == [("product", 1, 2)] and result.actions["product"]["inserted"] == 1


def test_merge_needs_a_catalog_that_supports_it(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    spark.sql("CREATE TABLE IF NOT EXISTS merge_product (ean bigint, title string, size int, price decimal(38,10), "
              "add_dtime timestamp_ntz, upd_dtime timestamp_ntz) USING parquet")
    space.archive.append(archive(spark, [doc(1, title="a")]))
    with pytest.raises(Exception, match="(?i)merge"):
        apply_snapshot(space, SPEC, 1, NOW, MergeApplier(lambda name: "default.merge_" + name))


def test_nothing_to_apply(spark, tmp_path):
    space = Workspace(spark, str(tmp_path))
    result = apply_snapshot(space, SPEC, 1, NOW)
    assert (result.total, result.failed) == (0, 0) and space.tables.read("product") is None
    space.archive.append(archive(spark, ["<broken"]))
    result = apply_snapshot(space, SPEC, 1, NOW)
    assert (result.total, result.failed) == (1, 1) and space.tables.read("product") is None
