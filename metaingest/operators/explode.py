"""From manifest pages to manifest records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions._cols import as_col
from ..functions.documents import record_chunks
from ..functions.minilang import is_blank
from ..functions.paths import path_kind, whole_text_path
from ..functions.typed import numeric_key
from ..specs import ApiSpec

PAGE_NOT_DOCUMENT = "page_not_a_document"
BLANK_KEY = "blank_key"
KEY_NOT_NUMERIC = "key_not_numeric"


def response_filter(body, path: str) -> Column:
    """Record passes if the path selects anything in it; no path passes all.

    ``body`` must be well-formed, as record bodies are by construction.
    """
    return F.xpath_boolean(as_col(body), F.lit(path)) if path else F.lit(True)


def explode_records(
    pages: DataFrame, change_api: ApiSpec, data_api: ApiSpec | None = None, body: str = "body"
) -> DataFrame:
    """One row per record of each page, in the page's order.

    Other page columns are kept; new columns are ``record_no``, ``key``,
    ``notification`` (the record's XML), ``args`` (final request arguments of
    the data API) and ``reason`` (null for a usable record). A page that is no
    document gives one row that only has a reason.
    """
    templates = data_api.request_args if data_api else {}
    path_templates = {k: v for k, v in templates.items() if v.startswith(urls.PATH_PREFIX)}
    tree_paths = [v for v in path_templates.values() if path_kind(v) == "tree"]
    other_paths = len(tree_paths) < len(path_templates)
    parsed = record_chunks(
        pages, body, change_api.record_tag, change_api.key_tag, change_api.content_type, tree_paths,
        whole_texts=other_paths, filter_path=change_api.response_filter,
    )
    keep = [c for c in parsed.columns if c not in ("_first", "_records")]
    # The page flag is taken before the explode: the explode then drops the
    # array instead of copying it into each of its rows.
    parsed = parsed.withColumn("_bad_page", F.col("_records").isNull())
    rows = parsed.select(
        *keep, "_bad_page", "_first", F.posexplode_outer("_records").alias("_in_chunk", "_r")
    ).where(F.col("_bad_page") | F.col("_r").isNotNull())
    if change_api.response_filter:
        # XPath reads the record anew, so it is asked only where the page's parse has not told.
        passes = F.coalesce("_r.passes", response_filter("_r.body", change_api.response_filter))
        rows = rows.where(F.col("_bad_page") | passes)
    return rows.select(
        *keep,
        (F.col("_first") + F.col("_in_chunk")).alias("record_no"),
        F.col("_r.key").alias("key"),
        F.col("_r.body").alias("notification"),
        _request_args(templates, tree_paths).alias("args"),
        F.when(F.col("_bad_page"), PAGE_NOT_DOCUMENT).otherwise(key_problem("_r.key")).alias("reason"),
    )


def key_problem(key) -> Column:
    """Why a record key cannot be used, or null."""
    return F.when(is_blank(key), BLANK_KEY).when(numeric_key(key).isNull(), KEY_NOT_NUMERIC)


def _request_args(templates: dict[str, str], tree_paths: list[str]) -> Column:
    """Literals first, then the values found by paths; paths without a value are dropped."""
    no_args = F.create_map().cast("map<string,string>")
    literals = {k: v for k, v in templates.items() if not v.startswith(urls.PATH_PREFIX)}
    found = []
    for name, path in templates.items():
        if not path.startswith(urls.PATH_PREFIX):
            continue
        if path in tree_paths:
            values = F.get(F.col("_r.values"), F.lit(tree_paths.index(path)))
        else:
            values = F.xpath("_r.marked", F.lit(whole_text_path(path)))
        found += [F.lit(name), urls.joined_values(values)]
    fixed = F.create_map(*[F.lit(x) for pair in literals.items() for x in pair]) if literals else no_args
    if not found:
        return fixed
    return F.map_concat(fixed, F.map_filter(F.create_map(*found), lambda _k, v: v.isNotNull()))
