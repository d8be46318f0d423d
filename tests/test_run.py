"""Ledger, full runs, resuming, streaming."""

from __future__ import annotations

from datetime import datetime

import pytest
from helpers import BASE, STATION_BUCKETS, change_row, config, data_row, page, payload, record
from pyspark.sql import functions as F

from metaingest import LandedInputs, LiveInputs, Workspace, run
from metaingest.operators.runs import incremental_start, last_run, resume_candidate
from metaingest.operators.specs import load_specs
from metaingest.plans.apply import apply_snapshot
from metaingest.plans.pull import pull
from metaingest.session import local_rows
from metaingest.sources.ledger import Ledger
from metaingest.streaming.apply import stream_apply
from metaingest.streaming.land import stream_archive

NOW, LATER = datetime(2024, 1, 10), datetime(2024, 1, 11)
FIRST = f"{BASE}?set=all"


def frames(spark, pages, payloads):
    return LandedInputs(
        spark.createDataFrame(pages, "process_id bigint, url string, body string"),
        spark.createDataFrame(payloads, "key string, body string"),
    )


def one_process(spark, **change):
    return config(spark, [(1, "", "one", "Y")], [change_row(1, **change), data_row(1)], {1: STATION_BUCKETS})


def spec_of(spark, **change):
    (spec,), _ = load_specs(spark, *one_process(spark, **change))
    return spec


def test_ledger_events_fold_to_runs(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    first = ledger.open_run(1, NOW)
    ledger.save_anchor(first, 1, NOW, "http://a")
    ledger.save_anchor(first, 1, NOW, "http://b")
    second = ledger.open_run(2, NOW)
    assert ledger.reserve_pages(first, 1, NOW, 5) == 0
    assert Ledger(spark, str(tmp_path)).reserve_pages(second, 2, NOW, 1) == 5
    ledger = Ledger(spark, str(tmp_path))
    ledger.fail(first, 1, LATER, "http://b", "broke")
    ledger.complete(second, 2, LATER, 7)
    rows = {r.change_id: r for r in ledger.state().collect()}
    assert (rows[1].status, rows[1].last_anchor, rows[1].start_dtime, rows[1].status_message) == ("F", "http://b", NOW, "broke")
    assert (rows[2].status, rows[2].total_records, rows[2].end_dtime, rows[2].upd_dtime) == ("C", 7, LATER, LATER)
    assert tuple(ledger.resume_point(1)) == (1, "http://b") and ledger.resume_point(2) is None


def ledger_rows(spark, rows):
    return spark.createDataFrame(
        [(1, i, s, datetime(2024, 1, d), a) for i, s, d, a in rows],
        "process_id bigint, change_id bigint, status string, start_dtime timestamp_ntz, last_anchor string",
    )


@pytest.mark.parametrize(
    "rows, start, anchor",
    [
        ([], datetime(2023, 12, 11), None),
        ([(1, "C", 2, "x")], datetime(2024, 1, 2), None),
        ([(1, "C", 2, ""), (2, "F", 3, "http://a")], datetime(2024, 1, 3), "http://a"),
        ([(1, "C", 2, ""), (2, "F", 3, "")], datetime(2024, 1, 2), None),
        ([(1, "F", 1, "http://a"), (2, "C", 2, "")], datetime(2024, 1, 2), None),
        ([(1, "F", 1, "http://a")], datetime(2024, 1, 1), "http://a"),
        ([(1, "C", 5, ""), (2, "C", 4, "")], datetime(2024, 1, 4), None),
    ],
)
def test_incremental_start(spark, rows, start, anchor):
    processes = spark.createDataFrame([(1,)], "process_id bigint")
    found = incremental_start(ledger_rows(spark, rows), processes, F.lit(NOW).cast("timestamp_ntz")).first()
    assert (found.start_dtime, found.last_anchor) == (start, anchor)


def test_last_run_and_resume(spark):
    rows = ledger_rows(spark, [(1, "F", 1, "a"), (3, "P", 2, "b"), (2, "C", 3, "c")])
    assert last_run(rows, "C").first().change_id == 2
    assert tuple(resume_candidate(rows).first()) == (1, 3, "b")


def test_full_run(spark, tmp_path):
    tables = config(
        spark,
        [(1, "", "pages", "Y"), (2, "", "keys", "Y"), (3, "", "idle", "N"), (4, "", "bare", "Y"), (5, "", "bad", "Y")],
        [
            change_row(1, content_type="xml"), data_row(1),
            change_row(2, base_url=" ", target_key_list="1, 5,x,1"), data_row(2),
            change_row(5, base_url="", target_key_list=""), data_row(5),
        ],
        {1: STATION_BUCKETS, 2: STATION_BUCKETS, 5: STATION_BUCKETS},
    )
    inputs = frames(
        spark,
        [
            (1, FIRST, page(record(1) + record(2, "shut") + record("nokey"), "true", "&amp;n=2")),
            (1, f"{FIRST}&n=2", page("", "true", "http://h/3")),
            (1, "http://h/3", page(record(3, "trial") + record(1) + record(4))),
            (1, "http://h/unlinked", page(record(8))),
            (2, FIRST, page(record(8))),
        ],
        [
            ("1", payload(1, place="one", river="Rhine", level="9.99")),
            ("3", payload(3, place="", level="1e1")),
            ("5", payload(5, place="five")),
        ],
    )
    results = {r.process_id: r for r in run(spark, *tables, str(tmp_path), inputs, NOW)}
    assert sorted(results) == [1, 2, 4, 5]
    assert results[4].error == "no API configuration" and "neither" in results[5].error
    space = Workspace(spark, str(tmp_path))
    archived = space.archive.read(1).orderBy("id").collect()
    assert [r.ean for r in archived] == [1, 3, 1, 4] and len({r.id for r in archived}) == 4
    bad = sorted((r.change_id, r.stage, r.key, r.reason) for r in space.quarantine.read().collect())
    assert bad == [
        (1, "apply", "4", "error_payload"), (1, "pull", "nokey", "key_not_numeric"), (2, "pull", "x", "key_not_numeric"),
    ]
    rows = {r.STATION_NO: r for r in space.tables.read("station").collect()}
    assert sorted(rows) == [1, 3, 5]
    assert (rows[1].PLACE, rows[1].RIVER_CD, float(rows[1].LEVEL_M)) == ("one", "Rhin", 9.99)
    assert rows[3].PLACE is None and float(rows[3].LEVEL_M) == 10.0
    runs = {r.change_id: (r.process_id, r.status, r.total_records) for r in space.ledger.state().collect()}
    assert runs == {1: (1, "C", 5), 2: (2, "C", 3)}


def test_json_payloads_and_pages(spark, tmp_path):
    tables = config(
        spark,
        [(1, "", "json", "Y")],
        [change_row(1, content_type="JSON", xpath_resp_filter=None), data_row(1, content_type="Json")],
        {1: STATION_BUCKETS},
    )
    inputs = frames(
        spark,
        [(1, FIRST, '{"register": {"entry": [{"no": 9781234567890}]}}')],
        [("9781234567890", '{"station": {"no": 9781234567890, "site": {"place": "Lower lock", "river": "Rhine"}, "gauge": {"level": 2.75}}}')],
    )
    (result,) = run(spark, *tables, str(tmp_path), inputs, NOW)
    assert result.error is None
    row = Workspace(spark, str(tmp_path)).tables.read("station").first()
    assert (row.STATION_NO, row.PLACE, row.RIVER_CD, float(row.LEVEL_M)) == (9781234567890, "Lower lock", "Rhin", 2.75)


def test_incremental_window_in_the_request(spark, tmp_path):
    spec = spec_of(spark, since_url_arg_nm="since", request_filter_args="since=1d,set=all")
    empty = frames(spark, [(1, "http://none", page())], [("0", "")])
    asked = []
    empty.page_batches = lambda spark, spec, url: asked.append(url) or iter(())
    space = Workspace(spark, str(tmp_path))
    pull(spark, space, spec, empty, NOW)
    spec = spec_of(spark, since_url_arg_nm="since")
    pull(spark, space, spec, empty, LATER)
    pull(spark, space, spec_of(spark), empty, LATER)
    assert asked == [
        f"{BASE}?since=1704758400000&set=all",
        f"{BASE}?set=all&since=1704843900000",
        FIRST,
    ]


def test_live_run_resumes_at_its_anchor(spark, tmp_path):
    spec = spec_of(spark, xpath_resp_filter=None)
    bodies = {
        FIRST: page(record(1), "true", "http://h/2"),
        "http://h/2": page(record(2), "true", "http://h/3"),
        "http://h/3": page(record(3)),
    }
    stations = {str(n): payload(n, place=f"p{n}") for n in (1, 2, 3)}

    def transport_without(missing):
        def transport(url, headers):
            if url == missing:
                raise OSError("down")
            if url.startswith("http://h/station"):
                return stations[url.split("no=")[1].split("&")[0]]
            return bodies[url]

        return transport

    space = Workspace(spark, str(tmp_path))
    with pytest.raises(Exception, match="down"):
        pull(spark, space, spec, LiveInputs(transport_without("http://h/3"), segment_pages=1), NOW)
    state = space.ledger.state().first()
    assert (state.status, state.last_anchor) == ("F", "http://h/3")
    assert sorted(r.ean for r in space.archive.read(1).collect()) == [1, 2]

    change_id = pull(spark, space, spec, LiveInputs(transport_without(None), segment_pages=1), LATER)
    assert change_id == 1
    assert [r.ean for r in space.archive.read(1).orderBy("id").collect()] == [1, 2, 3]
    assert space.ledger.state().first().status == "C"
    result = apply_snapshot(space, spec, 1, LATER)
    assert result.actions["station"]["inserted"] == 3


def test_numbered_pages_resume_without_a_chain(spark, tmp_path):
    spec = spec_of(spark, xpath_resp_filter=None)
    rows = [(1, 0, FIRST, page(record(1))), (1, 1, "http://h/2", page(record(2))), (1, 2, "http://h/3", page(record(3)))]
    inputs = LandedInputs(
        spark.createDataFrame(rows, "process_id bigint, page_no bigint, url string, body string"),
        spark.createDataFrame([("2", payload(2, place="b"))], "key string, body string"),
    )
    space = Workspace(spark, str(tmp_path))
    change_id = space.ledger.open_run(1, NOW)
    space.ledger.save_anchor(change_id, 1, NOW, "http://h/2")
    assert pull(spark, space, spec, inputs, NOW) == change_id
    assert [r.ean for r in space.archive.read(change_id).orderBy("id").collect()] == [2, 3]


def test_stream_equals_batch(spark, tmp_path):
    spec = spec_of(spark, xpath_resp_filter=None)
    rows = [(1, n, f"http://h/{n}" if n else FIRST, page(record(2 * n) + record(2 * n + 1))) for n in range(6)]
    pages = spark.createDataFrame(rows, "process_id bigint, page_no bigint, url string, body string")
    bodies = [(str(n), payload(n, place=f"t{n}", level=n)) for n in range(12)]
    inputs = LandedInputs(pages, spark.createDataFrame(bodies, "key string, body string"))

    batch = Workspace(spark, str(tmp_path / "batch"))
    apply_snapshot(batch, spec, pull(spark, batch, spec, inputs, NOW), NOW)

    stream = Workspace(spark, str(tmp_path / "stream"))
    landed = str(tmp_path / "landed")
    change_id = stream.ledger.open_run(1, NOW)

    def land(wanted):
        pages.where(wanted).repartition(2).write.mode("append").parquet(landed)
        stream_archive(spark, landed, stream, spec, inputs, change_id, NOW, str(tmp_path / "cp1"), 1).awaitTermination()
        stream_apply(spark, stream, spec, NOW, str(tmp_path / "cp2"), files_per_batch=2).awaitTermination()

    land("page_no < 3")
    land("page_no >= 3")
    left, right = (s.tables.read("station").orderBy("STATION_NO").collect() for s in (batch, stream))
    assert len(left) == 12 and left == right
    # A stream that starts over from the beginning changes nothing.
    stream_apply(spark, stream, spec, LATER, str(tmp_path / "cp3")).awaitTermination()
    assert stream.tables.read("station").orderBy("STATION_NO").collect() == left


def test_nothing_landed(spark, tmp_path):
    spec = spec_of(spark)
    space = Workspace(spark, str(tmp_path))
    pages = local_rows(spark, "process_id bigint, url string, body string")
    inputs = LandedInputs(pages, local_rows(spark, "key string, body string"))
    with pytest.raises(LookupError, match="not landed"):
        pull(spark, space, spec, inputs, NOW)
    state = space.ledger.state().first()
    assert (state.status, state.last_anchor) == ("F", "") and FIRST in state.status_message


def landing(spark, rows):
    return spark.createDataFrame(rows, "process_id bigint, url string, body string, batch int")


def test_a_gap_in_the_chain_fails_the_run_where_it_goes_on_later(spark, tmp_path):
    spec = spec_of(spark, xpath_resp_filter=None)
    space = Workspace(spark, str(tmp_path))
    rows = [(1, FIRST, page(record(1), "true", "http://h/2"), 1)]
    payloads = spark.createDataFrame([("1", payload(1, place="a")), ("2", payload(2, place="b"))], "key string, body string")
    with pytest.raises(LookupError, match="http://h/2"):
        pull(spark, space, spec, LandedInputs(landing(spark, rows), payloads, page_order="batch"), NOW)
    state = space.ledger.state().first()
    assert (state.status, state.last_anchor) == ("F", "http://h/2")
    rows.append((1, "http://h/2", page(record(2)), 2))
    assert pull(spark, space, spec, LandedInputs(landing(spark, rows), payloads, page_order="batch"), LATER) == 1
    assert [r.ean for r in space.archive.read(1).orderBy("id").collect()] == [1, 2]
    assert space.ledger.state().first().status == "C"


def test_the_latest_landing_of_a_page_counts(spark, tmp_path):
    spec = spec_of(spark, xpath_resp_filter=None)
    space = Workspace(spark, str(tmp_path))
    rows = [(1, FIRST, page(record(1)), 1), (1, FIRST, page(record(2)), 2)]
    inputs = LandedInputs(landing(spark, rows), spark.createDataFrame([("1", "x")], "key string, body string"), page_order="batch")
    assert [r.ean for r in space.archive.read(pull(spark, space, spec, inputs, NOW)).collect()] == [2]


def test_pages_that_share_a_number_fail_the_run(spark, tmp_path):
    rows = [(1, 0, FIRST, page(record(1))), (1, 0, "http://h/2", page(record(2)))]
    inputs = LandedInputs(
        spark.createDataFrame(rows, "process_id bigint, page_no bigint, url string, body string"),
        spark.createDataFrame([("1", "x")], "key string, body string"),
    )
    with pytest.raises(ValueError, match="2 pages have 1 numbers"):
        pull(spark, Workspace(spark, str(tmp_path)), spec_of(spark), inputs, NOW)


def test_a_run_whose_apply_failed_is_applied_by_the_next(spark, tmp_path):
    class Broken:
        def apply(self, incoming, target, now, expected_rows):
            raise RuntimeError("no space")

    tables, root = one_process(spark, xpath_resp_filter=None), str(tmp_path)
    bodies = [("1", payload(1, place="a")), ("2", payload(2, place="b"))]
    (first,) = run(spark, *tables, root, frames(spark, [(1, FIRST, page(record(1)))], bodies), NOW, Broken())
    space = Workspace(spark, root)
    assert "no space" in first.error and space.ledger.unapplied(1) == [1]
    (second,) = run(spark, *tables, root, frames(spark, [(1, FIRST, page(record(2)))], bodies), LATER)
    assert second.error is None and second.change_id == 2
    assert Workspace(spark, root).ledger.unapplied(1) == []
    assert sorted(r.STATION_NO for r in space.tables.read("station").collect()) == [1, 2]
