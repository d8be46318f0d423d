"""Small formats, URLs, times and typed equality."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from metaingest.functions import minilang as ml
from metaingest.functions import times, typed, urls
from metaingest.sources.pages import plain_url


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, {}),
        ("", {}),
        ("a=1,b=2", {"a": "1", "b": "2"}),
        ("a=b=c,x", {}),
        ("a=1,b=2,a=3", {"a": "3", "b": "2"}),
        ("a=,=b", {"a": "", "": "b"}),
        ("lang=en,no=//entry/no", {"lang": "en", "no": "//entry/no"}),
    ],
)
def test_kv_map(spark, text, expected):
    parsed = ml.kv_map(F.lit(text).cast("string"))
    assert one(spark, parsed) == expected
    assert one(spark, F.map_keys(parsed)) == list(expected)


def test_flags_and_content_type(spark):
    row = spark.range(1).select(
        ml.is_yes(F.lit("Y")), ml.is_yes(F.lit("y")), ml.is_true_text(F.lit("TrUe")), ml.is_true_text(F.lit("yes")),
        ml.content_type(F.lit("json")), ml.content_type(F.lit("other")), ml.content_type(F.lit(None).cast("string")),
        ml.is_blank(F.lit("  ")), ml.is_table_key_list(F.lit("tmp_list")), ml.is_table_key_list(F.lit("1,2")),
    ).first()
    assert tuple(row) == (True, False, True, False, "JSON", "XML", "XML", True, True, False)


@pytest.mark.parametrize(
    "args, expected",
    [({}, "http://h/{0}"), ({"a": "1", "e": "", "b": "2"}, "http://h/{0}?a=1&b=2")],
)
def test_format_url(spark, args, expected):
    column = F.create_map(*[F.lit(x) for p in args.items() for x in p]) if args else F.create_map().cast("map<string,string>")
    assert one(spark, urls.format_url(F.lit("http://h/{0}"), column)) == expected == plain_url("http://h/{0}", args)


def test_url_encoding_is_optional(spark):
    args = F.create_map(F.lit("q"), F.lit("a b&c"))
    assert one(spark, urls.format_url(F.lit("u"), args)) == "u?q=a b&c"
    assert one(spark, urls.format_url(F.lit("u"), args, url_encode=True)) == "u?q=a+b%26c"


@pytest.mark.parametrize(
    "anchor, expected",
    [("HTTPS://x/y", "HTTPS://x/y"), ("&n=2", "http://h?p=Q1&n=2"), ("", None), (None, None)],
)
def test_anchor_url(spark, anchor, expected):
    args = F.create_map(F.lit("p"), F.lit("Q1"))
    assert one(spark, urls.anchor_url(F.lit("http://h"), args, F.lit(anchor).cast("string"))) == expected


def test_argument_routing(spark):
    args = ml.kv_map(F.lit("lang=en,no=//entry/no,none=//x"))
    found = F.create_map(F.lit("no"), F.lit("1,2"), F.lit("none"), F.lit(""))
    assert one(spark, urls.literal_args(args)) == {"lang": "en"}
    assert one(spark, urls.path_args(args)) == {"no": "//entry/no", "none": "//x"}
    assert one(spark, urls.final_args(args, found)) == {"lang": "en", "no": "1,2"}


def test_joined_values_keep_first_seen_order(spark):
    values = F.array(*[F.lit(v) for v in ("b", "", "a", "b")])
    assert one(spark, urls.joined_values(values)) == "b,a"


def test_key_manifest_is_escaped(spark):
    assert one(spark, urls.key_manifest(F.lit("<1&2>"))) == "<record><key>&lt;1&amp;2&gt;</key></record>"


def test_epoch_does_not_depend_on_the_session_zone(spark):
    ts = F.lit("2024-01-01 00:00:00.123").cast("timestamp_ntz")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(spark, times.epoch_millis(ts)) == 1704067200123
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "since, start, expected",
    [
        ("1d", "2024-01-05", "2024-01-09 00:00:00"),
        ("fixed", "2024-01-05", None),
        ("d", "2024-01-05", None),
        (None, "2024-01-05", "2024-01-04 23:45:00"),
        (None, None, "2023-12-10 23:45:00"),
    ],
)
def test_since_millis(spark, since, start, expected):
    now = times.timestamp("2024-01-10")
    found = one(spark, times.since_millis(F.lit(since).cast("string"), F.lit(start).cast("timestamp_ntz"), now))
    wanted = None if expected is None else one(spark, times.epoch_millis(times.timestamp(expected)))
    assert found == wanted


@pytest.mark.parametrize(
    "name, db_type, spark_type, kind",
    [
        ("Varchar2", "VarChar", "string", "string"),
        ("Clob", "Text", "string", "string"),
        ("Int32", "Int", "int", "integer"),
        ("Int64", "BigInt", "bigint", "integer"),
        ("Double", "Decimal", "decimal(38,10)", "double"),
        ("DateTime", "DateTime", "timestamp_ntz", "date"),
        ("Unknown", "VarChar", "string", "string"),
        (None, "VarChar", "string", "string"),
    ],
)
def test_type_mapping(name, db_type, spark_type, kind):
    assert typed.map_type(name) == (db_type, spark_type)
    assert typed.comparison_class(db_type) == kind


@pytest.mark.parametrize(
    "old, new, kind, equal",
    [
        ("1.50", "1.5", "double", True),
        ("1.50", "1.5", "string", False),
        ("007", "7", "integer", True),
        ("2024-01-01", "2024-01-01 00:00:00", "date", True),
        ("", None, "date", True),
        (None, None, "double", True),
        ("", "0", "integer", False),
        ("abc", "abc", "integer", True),
        ("abc", "7", "integer", False),
        ("1e2", "100", "double", True),
    ],
)
def test_typed_equality(spark, old, new, kind, equal):
    left, right = F.lit(old).cast("string"), F.lit(new).cast("string")
    assert one(spark, typed.text_equal(left, right, kind)) is equal


@pytest.mark.parametrize(
    "text, kind, length, stored, fits",
    [
        ("English", "string", 3, "Eng", True),
        ("", "string", 3, None, True),
        ("12", "int", -1, 12, True),
        ("12.5", "int", -1, None, False),
        ("", "int", -1, None, True),
        (None, "bigint", -1, None, True),
        ("99999999999", "int", -1, None, False),
    ],
)
def test_storing(spark, text, kind, length, stored, fits):
    value = F.lit(text).cast("string")
    assert one(spark, typed.to_column_type(value, kind, length)) == stored
    assert one(spark, typed.fits_type(value, kind)) is fits


@pytest.mark.parametrize(
    "text, kind, keeps",
    [
        ("0.1234567890", "decimal(38,10)", True),
        ("0.123456789012345", "decimal(38,10)", False),
        ("1e-11", "decimal(38,10)", False),
        ("10e-11", "decimal(38,10)", True),
        ("0e-99", "decimal(38,10)", True),
        ("1.5000000000000000", "decimal(38,10)", True),
        ("-12345678901234567890.00000000001", "decimal(38,10)", False),
        ("100E-2", "decimal(5,0)", True),
        ("105E-2", "decimal(5,0)", False),
        ("1.25", "decimal(5,2)", True),
        (".255", "decimal(5,2)", False),
        ("word", "decimal(5,2)", True),
        ("", "decimal(5,2)", True),
        (None, "decimal(5,2)", True),
        ("2024-01-01 00:00:00.1234567", "timestamp_ntz", False),
        ("2024-01-01 00:00:00.1234560", "timestamp_ntz", True),
        ("12", "bigint", True),
    ],
)
def test_values_that_a_type_would_alter(spark, text, kind, keeps):
    assert one(spark, typed.keeps_value(F.lit(text).cast("string"), kind)) is keeps


def test_sized_decimal_types():
    assert typed.map_type("Decimal(12,2)") == ("Decimal", "decimal(12,2)")
    assert typed.map_type("Double( 20 )") == ("Decimal", "decimal(20,0)")
    assert typed.map_type("Varchar2(20)") == ("VarChar", "string")
    for bad in ("Decimal(39,2)", "Decimal(4,5)", "Decimal(0)"):
        with pytest.raises(ValueError):
            typed.map_type(bad)
