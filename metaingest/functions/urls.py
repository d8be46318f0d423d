"""Request and anchor URLs, and the arguments that go into them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col

PATH_PREFIX = "//"


def format_url(base: ColumnLike, args: ColumnLike, url_encode: bool = False) -> Column:
    """``base?k=v&k=v`` from a string map; empty and null values are skipped."""
    entries = F.filter(F.map_entries(as_col(args)), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    pairs = F.transform(
        entries,
        lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"]) if url_encode else e["value"]),
    )
    query = F.array_join(pairs, "&")
    return F.concat(as_col(base), F.when(F.coalesce(query, F.lit("")) != "", F.concat(F.lit("?"), query)).otherwise(""))


def anchor_url(base: ColumnLike, anchor_args: ColumnLike, anchor: ColumnLike) -> Column:
    """URL of the next page: absolute anchors as they are, others appended."""
    value = as_col(anchor)
    return F.when(F.lower(value).startswith("http"), value).when(
        value != "", F.concat(format_url(base, anchor_args), value)
    )


def literal_args(args: ColumnLike) -> Column:
    """Arguments whose value is a plain literal."""
    return F.map_filter(as_col(args), lambda _k, v: ~v.startswith(PATH_PREFIX))


def path_args(args: ColumnLike) -> Column:
    """Arguments whose value is a path into the manifest record."""
    return F.map_filter(as_col(args), lambda _k, v: v.startswith(PATH_PREFIX))


def joined_values(values: ColumnLike) -> Column:
    """Distinct non-empty values in first-seen order, joined by commas; null if none."""
    text = F.array_join(F.array_distinct(F.filter(as_col(values), lambda v: v != "")), ",")
    return F.nullif(text, F.lit(""))


def final_args(args: ColumnLike, found: ColumnLike) -> Column:
    """Literals first, then found path values; paths without a value are dropped."""
    hits = F.map_filter(as_col(found), lambda _k, v: F.coalesce(v, F.lit("")) != "")
    return F.map_concat(literal_args(args), hits)


def xml_text(value: ColumnLike) -> Column:
    """Text escaped for use as XML element content."""
    escaped = F.replace(as_col(value), F.lit("&"), F.lit("&amp;"))
    escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
    return F.replace(escaped, F.lit(">"), F.lit("&gt;"))


def key_manifest(key: ColumnLike, record_tag: str = "record", key_tag: str = "key") -> Column:
    """Manifest record body made up for a key that comes from a key list."""
    return F.concat(
        F.lit(f"<{record_tag}><{key_tag}>"), xml_text(key), F.lit(f"</{key_tag}></{record_tag}>")
    )
