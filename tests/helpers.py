"""Configuration rows and inputs shared by the tests."""

from __future__ import annotations

API_COLUMNS = (
    "process_id bigint, api_type string, base_url string, bucket_list string, since_url_arg_nm string, "
    "anchor_ind_tag_nm string, anchor_val_tag_nm string, anchor_filter_args string, request_filter_args string, "
    "xpath_resp_filter string, target_chld_tag string, target_chld_key_tag string, pulls_single_item_flag string, "
    "target_key_list string, content_type string, request_hdr_args string, is_url_since_epoch string"
)
PROCESS_COLUMNS = "process_id bigint, description string, process_name string, active_ind string"
BUCKET_COLUMNS = (
    "process_id bigint, api_type string, bucket_nm string, attr_nm string, target_table_nm string, "
    "attr_ora_type string, attr_ora_type_len int, attr_is_key string, attr_xpath string, attr_is_xml_body string"
)
BASE = "http://h/register"
SERVICE = "http://h/station"
IN_USE = "//state[. = 'open' or . = 'trial']"

STATION_BUCKETS = [
    ("site", "STATION_NO", "station", "BigInt", None, "Y", "/station/no", "N"),
    ("site", "PLACE", "station", "Varchar2", 40, "N", "/station/site/place", "N"),
    ("site", "RIVER_CD", "station", "Varchar2", 4, "N", "/station/site/river", "N"),
    ("gauge", "STATION_NO", "station", "BigInt", None, "Y", "/station/no", "N"),
    ("gauge", "LEVEL_M", "station", "Decimal", None, "N", "/station/gauge/level", "N"),
]


def api_row(process_id, api_type, **values):
    names = [part.split()[0] for part in API_COLUMNS.split(", ")]
    row = {"process_id": process_id, "api_type": api_type, "content_type": "XML", **values}
    return tuple(row.get(name) for name in names)


def change_row(process_id, **values):
    defaults = dict(
        base_url=BASE, bucket_list="site,gauge,photos", anchor_ind_tag_nm="more", anchor_val_tag_nm="cursor",
        anchor_filter_args="set=all", request_filter_args="set=all", xpath_resp_filter=IN_USE,
        target_chld_tag="entry", target_chld_key_tag="no",
    )
    return api_row(process_id, "C", **{**defaults, **values})


def data_row(process_id, **values):
    defaults = dict(
        base_url=SERVICE, bucket_list="site,gauge,photos",
        request_filter_args="units=metric,no=//entry/no,parts=//entry/part",
    )
    return api_row(process_id, "D", **{**defaults, **values})


def config(spark, processes, apis, buckets):
    """buckets: {process_id: rows without the leading process and type}"""
    rows = [(pid, "D", *row) for pid, some in buckets.items() for row in some]
    return (
        spark.createDataFrame(processes, PROCESS_COLUMNS),
        spark.createDataFrame(apis, API_COLUMNS),
        spark.createDataFrame(rows, BUCKET_COLUMNS),
    )


def page(records="", more="false", following=""):
    return f"<register><more>{more}</more><cursor>{following}</cursor>{records}</register>"


def record(no, state="open", part="site"):
    return f"<entry><no>{no}</no><part>{part}</part><state>{state}</state></entry>"


def payload(no, place=None, river=None, level=None):
    """A station's document; what is None is left out."""

    def element(tag, value):
        return "" if value is None else f"<{tag}>{value}</{tag}>"

    site = element("site", element("place", place) + element("river", river))
    return f"<station>{element('no', no)}{site}{'' if level is None else element('gauge', element('level', level))}</station>"
