"""Configuration rows to specs."""

from __future__ import annotations

from helpers import IN_USE, STATION_BUCKETS, change_row, config, data_row

from metaingest.operators.specs import active_processes, api_settings, bucket_rows, key_frame, load_specs
from metaingest.sources.config import CONFIG_TABLES, read_config
from metaingest.specs import ApiSpec


def load(spark, apis, buckets=None, processes=((1, "", "one", "Y"),)):
    return load_specs(spark, *config(spark, list(processes), apis, buckets or {1: STATION_BUCKETS}))


def test_sample_configuration(spark):
    header = "Api-Key=123,bad,a=b=c"
    (spec,), skipped = load(
        spark,
        [change_row(1, content_type="json", since_url_arg_nm="since", request_hdr_args=header), data_row(1)],
    )
    assert not skipped
    change, data = spec.change_api, spec.data_api
    assert (change.content_type, change.since_arg, change.response_filter) == ("JSON", "since", IN_USE)
    assert change.header_args == {"Api-Key": "123"}
    assert list(data.request_args) == ["units", "no", "parts"]
    assert [b.name for b in data.buckets] == ["site", "gauge", "photos"]
    main = data.buckets[0]
    assert [c.name for c in main.columns] == ["STATION_NO", "PLACE", "RIVER_CD"]
    assert main.keys == ("STATION_NO",) and main.columns[2].length == 4
    (target,) = data.targets()
    assert target.key_names == ["STATION_NO"] and len(target.buckets) == 2
    assert target.value_names == ["PLACE", "RIVER_CD", "LEVEL_M"]


def test_scans_are_ordered_and_filtered(spark):
    process, api, bucket = config(
        spark,
        [(3, "", "c", "Y"), (1, "", "a", "Y"), (2, "", "b", "N")],
        [data_row(1), change_row(1)],
        {1: STATION_BUCKETS},
    )
    assert [r.process_id for r in active_processes(process).collect()] == [1, 3]
    assert [r.api_type for r in api_settings(api).collect()] == ["C", "D"]
    assert [r.attr_nm for r in bucket_rows(bucket).collect()][:3] == ["STATION_NO", "LEVEL_M", "STATION_NO"]


def test_processes_that_cannot_run_are_reported(spark):
    both = [(n, "", "x", "Y") for n in range(1, 7)]
    bad_path = [("b", "K", "t", "Int64", None, "Y", "//a/text()", "N"), ("b", "V", "t", "Clob", None, "N", "//b", "N")]
    body_xpath = [("b", "K", "t", "Int64", None, "Y", "//a", "N"), ("b", "V", "t", "Clob", None, "N", "//b[a or c]", "Y")]
    specs, skipped = load(
        spark,
        [change_row(1), data_row(1), data_row(2), change_row(4), data_row(4), change_row(5), data_row(5),
         change_row(6, xpath_resp_filter="//a["), data_row(6)],
        {1: STATION_BUCKETS, 4: bad_path, 5: body_xpath, 6: STATION_BUCKETS},
        both,
    )
    assert [s.process_id for s in specs] == [1]
    assert sorted(skipped) == [2, 3, 4, 5, 6]
    assert skipped[3] == "no API configuration"


def test_bucket_without_key_is_a_problem_not_a_target(spark):
    rows = STATION_BUCKETS + [("price", "P", "other", "Decimal", None, "N", "//main/price", "N")]
    (spec,), _ = load(spark, [change_row(1), data_row(1)], {1: rows})
    assert [t.table for t in spec.data_api.targets()] == ["station"]
    assert spec.data_api.problems() == ["bucket price of table other has no key column"]


def test_key_lists(spark):
    inline = key_frame(spark, ApiSpec(key_list="1, 2,,1, "))
    assert sorted(r.key for r in inline.collect()) == ["1", "2"]
    assert key_frame(spark, ApiSpec(key_list=None)).isEmpty()
    source = spark.createDataFrame([(1,), (None,), (1,), (3,)], "ean bigint")
    stored = key_frame(spark, ApiSpec(key_list="wanted_parts", key_tag="ean"), lambda name: source)
    assert sorted(r.key for r in stored.collect()) == ["1", "3"]
    source.createOrReplaceTempView("wanted_parts")
    assert key_frame(spark, ApiSpec(key_list="wanted_parts", key_tag="ean")).count() == 2


def test_configuration_sources(spark, tmp_path):
    tables = config(spark, [(1, "", "one", "Y")], [change_row(1), data_row(1)], {1: STATION_BUCKETS})
    for frame, name in zip(tables, CONFIG_TABLES):
        frame.write.parquet(f"{tmp_path}/{name}")
        frame.createOrReplaceTempView(name)
    for source in (read_config(spark, str(tmp_path)), read_config(spark)):
        (spec,), skipped = load_specs(spark, *source)
        assert spec.process_id == 1 and not skipped
