"""Queries over the star-schema tables, each one exercising engine operators."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import minilang as ml
from ..functions import times, typed, urls
from ..functions._cols import field
from ..functions.documents import register_functions
from ..operators.explode import explode_records
from ..operators.extract import ATTRS, check_values, fan_out, parse_payloads
from ..operators.fold import last_writer_wins
from ..operators.lookup import lookup_payloads
from ..operators.runs import COMPLETED, incremental_start, last_run, resume_candidate
from ..operators.specs import bucket_rows, inline_keys, process_settings, table_keys
from ..operators.upsert import action_counts, row_count, rows_by_key, same_record, upsert_rows
from ..plans.apply import apply_snapshot
from ..plans.inputs import LandedInputs, LiveInputs, PageNotLanded
from ..plans.pull import archive_records, manifest_for_keys, pull
from ..plans.run import run
from ..plans.workspace import Workspace
from ..session import local_rows, scratch_path
from ..sources.archive import archive_id
from ..sources.ledger import ledger_state
from ..sources.payload_store import PayloadStore
from ..sources.pages import chain_positions, next_links, string_map
from ..specs import ApiSpec, BucketSpec, ColumnSpec
from ..streaming.apply import stream_apply
from ..streaming.land import finish_run, stream_archive, stream_pull
from . import data, transport
from .data import element, table

BEFORE, NOW, LATER = datetime(2024, 1, 1), datetime(2024, 6, 1), datetime(2024, 6, 2)
Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def attr(name: str, spark_type: str = "string", length: int = -1) -> Column:
    return typed.to_column_type(field(ATTRS, name), spark_type, length).alias(name)


# --- extraction ---------------------------------------------------------


@query
def extract_xml_scalar(spark, sf_dir):
    parts = data.part_archive(table(spark, sf_dir, "part"), data.full_part_payload())
    parsed = parse_payloads(parts, data.PART_API)
    return parsed.select(
        attr("ean", "bigint"), attr("title"), attr("size", "int"), attr("price", typed.DECIMAL_TYPE).cast("double").alias("price")
    )


@query
def extract_absent_vs_empty(spark, sf_dir):
    kind = F.col("p_partkey") % 3
    title = F.when(kind == 0, "").when(kind == 1, "<title/>").otherwise(element("title", F.col("p_name")))
    parts = data.part_archive(table(spark, sf_dir, "part"), data.part_payload(title))
    text = field(ATTRS, "title")
    state = F.when(text.isNull(), "absent").when(text == "", "empty").otherwise("value")
    return parse_payloads(parts, data.PART_API).select(attr("ean", "bigint"), state.alias("state"), attr("title"))


@query
def extract_xml_body(spark, sf_dir):
    api = ApiSpec(
        buckets=(
            BucketSpec(
                "body",
                "product_body",
                (
                    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
                    ColumnSpec("main_xml", "//main", "Clob", is_body=True),
                ),
            ),
        )
    )
    parts = data.part_archive(table(spark, sf_dir, "part"), data.full_part_payload())
    return parse_payloads(parts, api).select(attr("ean", "bigint"), attr("main_xml"))


@query
def extract_full_xpath(spark, sf_dir):
    """Paths beyond the element subset, and two paths for one attribute."""
    api = ApiSpec(
        buckets=(
            BucketSpec(
                "either",
                "product_any",
                (
                    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
                    ColumnSpec("label", "//main/title[../size > 25 or ../size < 5]"),
                ),
            ),
            BucketSpec("price", "product_any", (ColumnSpec("label", "/product/price/amount"),)),
        )
    )
    price = F.when(F.col("p_partkey") % 4 == 0, data.amount(F.col("p_size")))
    parts = data.part_archive(table(spark, sf_dir, "part"), data.part_payload(price=price))
    return parse_payloads(parts, api).select(attr("ean", "bigint"), attr("label"))


@query
def extract_json_path(spark, sf_dir):
    api = ApiSpec(
        content_type="JSON",
        buckets=(
            BucketSpec(
                "event",
                "event",
                (
                    ColumnSpec("event_id", "/event/id", "Int64", is_key=True),
                    ColumnSpec("kind", "//type"),
                    ColumnSpec("k", "//props/k", "Int32"),
                ),
            ),
        ),
    )
    events = table(spark, sf_dir, "events").select(
        F.concat(
            F.lit('{"event": {"id": '), F.col("event_id").cast("string"),
            F.lit(', "type": "'), F.col("event_type"),
            F.lit('", "props": '), F.col("props"), F.lit("}}"),
        ).alias("data")
    )
    return parse_payloads(events, api).select(attr("event_id", "bigint"), attr("kind"), attr("k", "int"))


@query
def quarantine_split(spark, sf_dir):
    """Why payloads cannot be used: broken parts of each kind, and raw web pages."""
    kind = F.col("p_partkey") % 7
    good = data.full_part_payload()
    broken = (
        F.when(kind == 0, F.lit("<response><errors><error>x</error></errors></response>"))
        .when(kind == 1, F.concat(good, F.lit("trailing")))
        .when(kind == 2, F.concat(F.lit("<product><main>"), element("ean", F.col("p_partkey")), F.lit("</main></product>")))
        .when(kind == 3, data.part_payload(price=data.amount(F.lit("n/a"))))
        .when(kind == 4, F.regexp_replace(good, "<ean>[^<]*</ean>", "<ean></ean>"))
        .when(kind == 5, F.lit(None).cast("string"))
        .otherwise(good)
    )
    parts = data.part_archive(table(spark, sf_dir, "part"), broken).select("data")
    pages = table(spark, sf_dir, "pages").select(F.col("html").alias("data"))
    checked = check_values(parse_payloads(parts.unionByName(pages), data.PART_API), data.PART_API)
    return checked.groupBy(
        F.coalesce("reason", F.lit("usable")).alias("reason"), F.coalesce("detail", F.lit("")).alias("detail")
    ).agg(F.count("*").alias("records"))


@query
def value_losses(spark, sf_dir):
    """Numbers and times that their columns can't hold as they are."""
    api = ApiSpec(
        buckets=(
            BucketSpec(
                "sizes",
                "part_sizes",
                (
                    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
                    ColumnSpec("cost", "//main/cost", "Decimal(12,2)"),
                    ColumnSpec("ratio", "//main/ratio", "Double"),
                    ColumnSpec("seen", "//main/seen", "DateTime"),
                ),
            ),
        )
    )
    kind, key = F.col("p_partkey") % 7, F.col("p_partkey").cast("string")
    cost = F.when(kind == 1, F.concat(key, F.lit(".125"))).when(kind == 2, F.concat(key, F.lit(".2500"))).otherwise(key)
    ratio = F.when(kind == 3, F.concat(key, F.lit("e-11"))).when(kind == 4, F.concat(key, F.lit(".12345678901"))).otherwise(F.concat(key, F.lit("e-10")))
    seen = F.concat(F.lit("2024-01-02 03:04:05."), F.when(kind == 5, "0000007").otherwise("0000010"))
    body = F.concat(F.lit("<p><main>"), element("ean", key), element("cost", cost), element("ratio", ratio), element("seen", seen), F.lit("</main></p>"))
    parts = data.part_archive(table(spark, sf_dir, "part"), body)
    checked = check_values(parse_payloads(parts, api), api)
    usable = F.col("reason").isNull()
    return checked.select(
        attr("ean", "bigint"),
        F.coalesce("reason", F.lit("")).alias("reason"),
        F.coalesce("detail", F.lit("")).alias("detail"),
        F.when(usable, typed.to_column_type(field(ATTRS, "cost"), "decimal(12,2)").cast("double")).alias("cost"),
        F.when(usable, F.round(typed.to_column_type(field(ATTRS, "ratio"), typed.DECIMAL_TYPE) * 10_000_000_000, 0).cast("bigint")).alias("ratio"),
    )


@query
def bucket_presence(spark, sf_dir):
    kind = F.col("p_partkey") % 4
    title = F.when(kind < 2, element("title", F.col("p_name"))).otherwise("<title/>")
    price = F.when(kind % 2 == 0, data.amount(F.col("p_retailprice")))
    payload = F.regexp_replace(data.part_payload(title, price), "<size>[^<]*</size>", "")
    parsed = parse_payloads(data.part_archive(table(spark, sf_dir, "part"), payload), data.PART_API)
    return fan_out(parsed, list(data.PART_API.buckets)).select(attr("ean", "bigint"), "bucket")


@query
def truncated_text(spark, sf_dir):
    """Texts cut to their column's length, and which columns were cut."""
    api = ApiSpec(
        buckets=(
            BucketSpec(
                "main",
                "product",
                (
                    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
                    ColumnSpec("title", "//main/title", "Varchar2", 8),
                ),
            ),
        )
    )
    parts = data.part_archive(table(spark, sf_dir, "part"), data.full_part_payload())
    checked = check_values(parse_payloads(parts, api), api)
    return checked.select(
        attr("ean", "bigint"), attr("title", length=8), F.array_join("truncated", ",").alias("truncated")
    )


# --- manifests ----------------------------------------------------------


@query
def records_of_pages(spark, sf_dir):
    pages = data.manifest_pages(table(spark, sf_dir, "part"))
    api = ApiSpec(record_tag="product", key_tag="ean")
    return explode_records(pages, api).select(
        "page_no",
        "record_no",
        F.col("key").cast("bigint").alias("ean"),
        "notification",
    )


@query
def json_array_records(spark, sf_dir):
    parts = table(spark, sf_dir, "part").withColumn("page_no", F.floor(F.col("p_partkey") / data.PAGE_ROWS))
    record = F.to_json(F.struct(F.col("p_partkey").alias("ean"), F.col("p_name").alias("title"), F.col("p_size").alias("size")))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", record.alias("record")))), lambda r: r["record"])
    pages = parts.groupBy("page_no").agg(
        F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")).alias("body")
    )
    api = ApiSpec(record_tag="product", key_tag="ean", content_type="JSON")
    return explode_records(pages, api).select(
        "page_no",
        "record_no",
        F.col("key").cast("bigint").alias("ean"),
        F.xpath_string("notification", F.lit("/product/title")).alias("title"),
        F.xpath_int("notification", F.lit("/product/size")).alias("size"),
    )


@query
def response_filter(spark, sf_dir):
    pages = data.manifest_pages(table(spark, sf_dir, "part"))
    return explode_records(pages, data.MANIFEST_API).select(F.col("key").cast("bigint").alias("ean"))


@query
def filter_args(spark, sf_dir):
    pages = data.manifest_pages(table(spark, sf_dir, "part"))
    api = ApiSpec(
        base_url="http://catalog.example/product",
        request_args={
            "detail": "full",
            "part": "//product/ean",
            "groups": "//product/group",
            "markets": "//market[string-length(.) > 1]",
        },
    )
    records = explode_records(pages, ApiSpec(record_tag="product", key_tag="ean"), api)
    return records.select(
        F.col("key").cast("bigint").alias("ean"),
        urls.format_url(F.lit(api.base_url), "args").alias("request_url"),
    )


@query
def xpath_args(spark, sf_dir):
    """Request arguments from paths that only XPath evaluates: whole texts of several matches."""
    tag = lambda name, *content: F.concat(F.lit(f"<{name}>"), *content, F.lit(f"</{name}>"))
    names = [tag("name", tag("maker", "p_name"), F.col("p_brand")), tag("name", F.col("p_type"))]
    record = tag("product", tag("ean", F.col("p_partkey").cast("string")), *names)
    pages = table(spark, sf_dir, "part").groupBy(F.floor(F.col("p_partkey") / 50).alias("page_no"))
    pages = pages.agg(tag("list", F.array_join(F.array_sort(F.collect_list(record)), "")).alias("body"))
    api = ApiSpec(
        base_url="http://catalog.example/product",
        request_args={
            "names": "//name[string-length(.) > 3]",
            "kind": "//name[contains(., 'Brand#3')]/following-sibling::name",
            "bare": "//name[count(@*) = 0 and maker]",
        },
    )
    records = explode_records(pages, ApiSpec(record_tag="product", key_tag="ean"), api)
    return records.select(
        F.col("key").cast("bigint").alias("ean"),
        urls.format_url(F.lit(api.base_url), "args").alias("request_url"),
    )


@query
def page_chain(spark, sf_dir):
    """Position of every page in its chain, found from the links alone."""
    pages = data.manifest_pages(table(spark, sf_dir, "part"), 20).select("process_id", "url", "body")
    starts = local_rows(spark, "process_id bigint, url string", [(1, f"{data.BASE_URL}?list=spares")])
    return chain_positions(next_links(pages, data.MANIFEST_API), starts).select("url", "page_no")


@query
def key_manifests(spark, sf_dir):
    """Manifest records made up for the keys of a table."""
    keys = table_keys(table(spark, sf_dir, "lineitem"), "l_partkey")
    change = ApiSpec(record_tag="product", key_tag="ean")
    records = manifest_for_keys(keys, change, data.PART_API)
    numbered = records.groupBy("key", "notification").agg(
        F.count_distinct(archive_id(F.col("page_no"), F.col("record_no"))).alias("ids"),
        F.max(urls.format_url(F.lit(data.PART_API.base_url), "args")).alias("request_url"),
    )
    return numbered.select(F.col("key").cast("bigint").alias("ean"), "notification", "ids", "request_url")


# --- small formats ------------------------------------------------------


@query
def parse_kv_list(spark, sf_dir):
    text = F.concat(
        F.lit("a=b=c,brand="), F.col("p_brand"), F.lit(",novalue,size="), F.col("p_size").cast("string"),
        F.lit(",type="), F.col("p_type"), F.lit(",size="), (F.col("p_size") + 1).cast("string"), F.lit(",blank="),
    )
    parsed = table(spark, sf_dir, "part").withColumn("args", ml.kv_map(text))
    return parsed.select(
        "p_partkey",
        F.array_join(F.map_keys("args"), ",").alias("arg_names"),
        F.col("args")["brand"].alias("brand"),
        F.col("args")["size"].alias("size"),
        F.col("args")["blank"].alias("blank"),
    )


@query
def format_url(spark, sf_dir):
    args = F.create_map(
        F.lit("id"), F.col("s_suppkey").cast("string"),
        F.lit("empty"), F.lit(""),
        F.lit("none"), F.lit(None).cast("string"),
        F.lit("nation"), F.when(F.col("s_nationkey") > 5, F.col("s_nationkey").cast("string")),
    )
    no_args = string_map({})
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        urls.format_url(F.lit("http://h/s"), args).alias("url"),
        urls.format_url(F.lit("http://h/s"), no_args).alias("bare_url"),
    )


@query
def anchor_url(spark, sf_dir):
    kind = F.col("c_custkey") % 3
    anchor = (
        F.when(kind == 0, F.concat(F.lit("HTTP://other/"), F.col("c_custkey").cast("string")))
        .when(kind == 1, F.concat(F.lit("&anchor="), F.col("c_custkey").cast("string")))
        .otherwise("")
    )
    args = string_map({"list": "spares"})
    return table(spark, sf_dir, "customer").select(
        "c_custkey", urls.anchor_url(F.lit(data.BASE_URL), args, anchor).alias("url")
    )


@query
def since_epoch_ms(spark, sf_dir):
    since = F.when(F.col("o_orderkey") % 3 == 0, F.concat((F.col("o_orderkey") % 40).cast("string"), F.lit("d"))).when(
        F.col("o_orderkey") % 3 == 1, "fixed"
    )
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        times.epoch_millis("o_orderdate").alias("start_ms"),
        times.since_millis(since, F.col("o_orderdate"), F.lit(NOW)).alias("since_ms"),
    )


# --- configuration ------------------------------------------------------


def customer_config(spark, sf_dir):
    """Configuration tables with a process per customer."""
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "process_id")
    cfg_process = customers.select(
        "process_id",
        F.col("c_name").alias("process_name"),
        F.when(F.col("c_nationkey") % 2 == 0, "Y").otherwise("N").alias("active_ind"),
    )
    sides = customers.withColumn("api_type", F.explode(F.array(F.lit("D"), F.lit("C"))))
    sides = sides.where((F.col("api_type") == "D") | (F.col("c_acctbal") > 0))
    cfg_api = sides.select(
        "process_id",
        "api_type",
        F.concat(F.lit("http://h/"), F.lower("api_type")).alias("base_url"),
        F.lit("main,pricing").alias("bucket_list"),
        F.lit("since").alias("since_url_arg_nm"),
        F.lit("remaining").alias("anchor_ind_tag_nm"),
        F.lit("cursor").alias("anchor_val_tag_nm"),
        F.lit("list=spares").alias("anchor_filter_args"),
        F.concat(F.lit("segment="), F.col("c_mktsegment"), F.lit(",a=b=c,since=1d")).alias("request_filter_args"),
        F.lit(None).cast("string").alias("xpath_resp_filter"),
        F.lit("product").alias("target_chld_tag"),
        F.lit("ean").alias("target_chld_key_tag"),
        F.lit(None).cast("string").alias("target_key_list"),
        F.when(F.col("c_nationkey") % 3 == 0, "json").otherwise("text").alias("content_type"),
        F.lit(None).cast("string").alias("request_hdr_args"),
    )
    attrs = F.array(
        F.struct(F.lit("TITLE").alias("attr_nm"), F.lit("N").alias("attr_is_key")),
        F.struct(F.lit("EAN").alias("attr_nm"), F.lit("Y").alias("attr_is_key")),
        F.struct(F.col("c_mktsegment").alias("attr_nm"), F.lit("N").alias("attr_is_key")),
    )
    cfg_bucket = customers.select("process_id", F.explode(attrs).alias("a")).select(
        "process_id",
        F.lit("D").alias("api_type"),
        F.lit("main").alias("bucket_nm"),
        "a.attr_nm",
        F.lit("spare_part").alias("target_table_nm"),
        F.when(F.col("a.attr_is_key") == "Y", "BigInt").otherwise("Varchar2").alias("attr_ora_type"),
        F.lit(None).cast("int").alias("attr_ora_type_len"),
        "a.attr_is_key",
        F.concat(F.lit("//main/"), F.lower("a.attr_nm")).alias("attr_xpath"),
        F.lit("N").alias("attr_is_xml_body"),
    )
    return cfg_process, cfg_api, cfg_bucket


@query
def config_specs(spark, sf_dir):
    settings = process_settings(*customer_config(spark, sf_dir))
    return settings.select(
        "process_id",
        "process_name",
        F.col("change_api.base_url").alias("change_url"),
        F.col("data_api.base_url").alias("data_url"),
        F.col("data_api.content_type").alias("content_type"),
        F.col("data_api.request_args")["segment"].alias("segment"),
        F.size("data_api.request_args").alias("arg_count"),
        F.array_join(F.flatten(F.transform("data_api.bucket_specs", lambda b: F.transform(b["columns"], lambda c: c["name"]))), ",").alias("columns"),
    )


@query
def config_bucket_rows(spark, sf_dir):
    return bucket_rows(customer_config(spark, sf_dir)[2]).select(
        "process_id", "bucket_nm", "attr_nm", "attr_len", "is_key", "attr_xpath"
    )


@query
def key_list(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    text = F.concat(F.col("p_partkey").cast("string"), F.lit(", ,"), F.col("p_size").cast("string"), F.lit(","))
    listed = inline_keys(parts.select(text.alias("keys")), "keys")
    stored = table_keys(table(spark, sf_dir, "lineitem"), "l_partkey")
    return listed.union(stored).distinct()


# --- lookup -------------------------------------------------------------


@query
def lookup_payload(spark, sf_dir):
    """Order lines as manifest records; some payloads are missing."""
    lines = table(spark, sf_dir, "lineitem")
    manifest = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("key"))
    parts = table(spark, sf_dir, "part").where("p_size > 5")
    payloads = parts.select(F.col("p_partkey").cast("string").alias("key"), data.full_part_payload().alias("body"))
    return lookup_payloads(manifest, payloads)


@query
def lookup_stored(spark, sf_dir):
    """Order lines looked up in a payload store of two landings, the second with new prices of some parts."""
    lines = table(spark, sf_dir, "lineitem")
    manifest = lines.select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("key"))
    parts = table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string").alias("key")
    store = PayloadStore(spark, scratch_path(spark, "payloads"))
    store.land(parts.where("p_size > 5").select(key, data.full_part_payload().alias("body")))
    raised = data.part_payload(price=data.amount(F.col("p_retailprice") + 1))
    store.land(parts.where("p_partkey % 3 = 0 and p_size > 2").select(key, raised.alias("body")))
    return lookup_payloads(manifest, store.newest(manifest))


# --- ledger -------------------------------------------------------------


def order_ledger(spark, sf_dir) -> DataFrame:
    """Orders as runs: customer = process, order = run."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("process_id"),
        F.col("o_orderkey").alias("change_id"),
        F.when(F.col("o_orderstatus") == "O", COMPLETED).otherwise(F.col("o_orderstatus")).alias("status"),
        F.col("o_orderdate").alias("start_dtime"),
        F.when(F.col("o_orderpriority").startswith("4"), "").otherwise(F.col("o_orderpriority")).alias("last_anchor"),
    )


@query
def ledger_argmax(spark, sf_dir):
    return last_run(order_ledger(spark, sf_dir), COMPLETED)


@query
def resume_point(spark, sf_dir):
    return resume_candidate(order_ledger(spark, sf_dir))


@query
def incremental_window(spark, sf_dir):
    processes = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("process_id"))
    starts = incremental_start(order_ledger(spark, sf_dir), processes, F.lit(NOW))
    return starts.withColumn("since_ms", times.epoch_millis(times.overlap_start("start_dtime")))


@query
def ledger_events(spark, sf_dir):
    """Each order as four events: opened, anchored, anchored again, finished."""
    orders = table(spark, sf_dir, "orders")
    nothing = F.lit(None).cast("string")

    def event(step: int, status: Column, anchor: Column, total: Column) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 4 + step).alias("event_id"),
            F.when(F.lit(step == 0), F.col("o_orderdate")).alias("start_dtime"),
            F.when(F.lit(step == 3), F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).alias("end_dtime"),
            total.cast("bigint").alias("total_records"),
            anchor.alias("last_anchor"),
            status.alias("status"),
            nothing.alias("status_message"),
            (F.col("o_orderdate") + F.make_dt_interval(hours=F.lit(step))).alias("at_dtime"),
        )

    final = F.when(F.col("o_orderstatus") == "O", "C").otherwise("F")
    no_total = F.lit(None).cast("bigint")
    events = orders.select(
        F.col("o_orderkey").alias("change_id"),
        F.col("o_custkey").alias("process_id"),
        F.inline(
            F.array(
                event(0, F.lit("P"), nothing, no_total),
                event(1, nothing, F.col("o_orderpriority"), no_total),
                event(2, nothing, F.when(F.col("o_orderkey") % 2 == 0, "last"), no_total),
                event(3, final, nothing, F.when(final == "C", F.col("o_custkey"))),
            )
        ),
    )
    return ledger_state(events).drop("status_message")


# --- fold, diff, upsert -------------------------------------------------


@query
def typed_diff(spark, sf_dir):
    kind = F.col("l_orderkey") % 4
    price, number = F.col("l_extendedprice").cast("string"), F.col("l_suppkey").cast("string")
    new_price = F.when(kind == 1, F.concat(price, F.lit("00"))).when(kind == 2, "").otherwise(price)
    new_number = F.when(kind == 3, F.lit(None).cast("string")).otherwise(F.concat(F.lit("0"), number))
    old_flag = F.when(kind == 0, "").otherwise(F.col("l_returnflag"))
    lines = table(spark, sf_dir, "lineitem")
    return lines.groupBy(
        "l_orderkey",
    ).agg(
        F.count_if(
            same_record(
                [(price, new_price, "double"), (number, new_number, "integer"), (old_flag, F.col("l_returnflag"), "string")]
            )
        ).alias("same"),
        F.count_if(typed.text_equal(price, new_price, "string")).alias("same_text"),
        F.count_if(
            typed.text_equal(F.col("l_shipdate").cast("string"), F.date_format("l_shipdate", "yyyy-MM-dd"), "date")
        ).alias("same_date"),
    )


def event_updates(spark, sf_dir) -> DataFrame:
    """Events as partial updates of a user: some values are absent."""
    return table(spark, sf_dir, "events").select(
        "user_id",
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("last_type"),
        F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 1, F.col("value").cast("string")).alias("last_value"),
    )


@query
def fold_updates(spark, sf_dir):
    return last_writer_wins(event_updates(spark, sf_dir), ["user_id"], ["last_type", "last_value"], "event_id")


@query
def fold_whole_rows(spark, sf_dir):
    return last_writer_wins(
        event_updates(spark, sf_dir), ["user_id"], ["last_type", "last_value"], "event_id", absent="null"
    )


def supplier_upsert(spark, sf_dir) -> DataFrame:
    """Half of the suppliers as target; all of them, changed, as incoming."""
    suppliers = table(spark, sf_dir, "supplier")
    stamp = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz")
    target = suppliers.where("s_nationkey < 15").select(
        "s_suppkey", "s_name", "s_acctbal", "s_nationkey", stamp.alias("add_dtime"), stamp.alias("upd_dtime")
    )
    kind = F.col("s_suppkey") % 4
    incoming = suppliers.where("s_nationkey >= 5").select(
        "s_suppkey",
        F.when(kind == 1, F.concat("s_name", F.lit("!"))).when(kind == 2, F.lit(None)).otherwise(F.col("s_name")).alias("s_name"),
        F.when(kind != 3, F.col("s_acctbal")).alias("s_acctbal"),
        F.struct((kind != 0).alias("s_name"), (kind != 3).alias("s_acctbal")).alias("present"),
    )
    return upsert_rows(target, incoming, ["s_suppkey"], ["s_name", "s_acctbal"], F.lit(NOW).cast("timestamp_ntz"))


@query
def upsert_full(spark, sf_dir):
    return supplier_upsert(spark, sf_dir)


@query
def upsert_counts(spark, sf_dir):
    return action_counts(supplier_upsert(spark, sf_dir))


@query
def target_by_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = lines.where("l_quantity > 49")
    return rows_by_key(lines, keys, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )


@query
def target_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


# --- composed -----------------------------------------------------------


def workspace(spark: SparkSession) -> Workspace:
    return Workspace(spark, scratch_path(spark, "workspace"))


def product_rows(target: DataFrame) -> DataFrame:
    return target.select(
        "ean", "title", "size", F.col("price").cast("double").alias("price"), "add_dtime", "upd_dtime"
    )


@query
def apply_parts(spark, sf_dir):
    """Two snapshots applied one after the other: insert, then partial update."""
    parts = table(spark, sf_dir, "part")
    space = workspace(spark)
    space.archive.append(data.part_archive(parts.where("p_size < 40"), data.full_part_payload(), 1))
    kind = F.col("p_partkey") % 4
    title = F.when(kind == 0, element("title", F.upper("p_name"))).when(kind == 1, "<title/>").otherwise("")
    price = F.when(kind == 2, data.amount(F.col("p_retailprice") + 1))
    space.archive.append(data.part_archive(parts.where("p_size >= 20"), data.part_payload(title, price), 2))
    apply_snapshot(space, data.PART_SPEC, 1, datetime(2024, 1, 1))
    apply_snapshot(space, data.PART_SPEC, 2, NOW)
    return product_rows(space.tables.read("product"))


@query
def apply_lines(spark, sf_dir):
    """Order lines under a compound key, several payloads per key."""
    lines = table(spark, sf_dir, "lineitem")
    space = workspace(spark)
    stamp = F.lit(NOW).cast("timestamp_ntz")
    archived = data.line_archive(lines).select(
        "id", "ean", F.lit("").alias("notification"), "data", stamp.alias("add_dtime"), stamp.alias("upd_dtime"), "change_id"
    )
    space.archive.append(archived, 1)
    apply_snapshot(space, data.LINE_SPEC, 1, NOW)
    target = space.tables.read("order_line")
    return target.select(
        "order_id", "line_no", F.col("quantity").cast("double").alias("quantity"),
        F.col("price").cast("double").alias("price"), "flag", "shipped",
    )


def part_config(spark, sf_dir):
    """Configuration of one manifest process over parts, one over listed keys, one idle."""
    process = spark.createDataFrame(
        [(1, "changed parts", "Y"), (2, "listed parts", "Y"), (3, "idle", "N")],
        "process_id bigint, process_name string, active_ind string",
    )
    api_columns = (
        "process_id bigint, api_type string, base_url string, bucket_list string, since_url_arg_nm string, "
        "anchor_ind_tag_nm string, anchor_val_tag_nm string, anchor_filter_args string, request_filter_args string, "
        "xpath_resp_filter string, target_chld_tag string, target_chld_key_tag string, target_key_list string, "
        "content_type string, request_hdr_args string"
    )
    wanted = "//market[. != 'ASIA']"
    service = "http://catalog.example/product"
    args = "detail=full,part=//product/ean"
    api = spark.createDataFrame(
        [
            (1, "C", data.BASE_URL, "main", None, "remaining", "cursor", "list=spares", "list=spares", wanted, "product", "ean", None, "XML", None),
            (1, "D", service, "main,price,availability", None, None, None, None, args, None, None, None, None, "XML", None),
            (2, "C", "", "", None, None, None, None, None, None, "product", "l_partkey", "key_source", "XML", None),
            (2, "D", service, "main", None, None, None, None, "part=//product/l_partkey", None, None, None, None, "XML", None),
        ],
        api_columns,
    )
    rows = []
    for process_id, table_nm in ((1, "product"), (2, "listed_product")):
        for bucket in data.PART_API.buckets[:2]:
            for c in bucket.columns:
                rows.append(
                    (process_id, "D", bucket.name, c.name, table_nm, c.config_type, c.length, "Y" if c.is_key else "N", c.path, "N")
                )
    bucket = spark.createDataFrame(
        rows,
        "process_id bigint, api_type string, bucket_nm string, attr_nm string, target_table_nm string, "
        "attr_ora_type string, attr_ora_type_len int, attr_is_key string, attr_xpath string, attr_is_xml_body string",
    )
    return process, api, bucket


def landed_inputs(spark, sf_dir) -> LandedInputs:
    parts = table(spark, sf_dir, "part")
    pages = data.manifest_pages(parts).select("process_id", "url", "body")
    payloads = parts.where("p_size <> 7").select(
        F.col("p_partkey").cast("string").alias("key"), data.full_part_payload().alias("body")
    )
    return LandedInputs(pages, payloads, key_table=lambda _name: table(spark, sf_dir, "lineitem"))


def run_parts(spark, sf_dir) -> Workspace:
    root = scratch_path(spark, "full-run")
    results = run(spark, *part_config(spark, sf_dir), root, landed_inputs(spark, sf_dir), NOW)
    failed = [r for r in results if r.error]
    if failed:
        raise RuntimeError(f"run failed: {failed}")
    return Workspace(spark, root)


@query
def full_run(spark, sf_dir):
    """Every active process, pulled and applied: both target tables together."""
    tables = run_parts(spark, sf_dir).tables
    changed = product_rows(tables.read("product")).withColumn("source", F.lit("manifest"))
    listed = product_rows(tables.read("listed_product")).withColumn("source", F.lit("key list"))
    return changed.unionByName(listed)


@query
def full_run_ledger(spark, sf_dir):
    """The ledger after a run, and what went to quarantine."""
    space = run_parts(spark, sf_dir)
    bad = space.quarantine.read().groupBy("change_id", "reason").agg(F.count("*").alias("bad"))
    return (
        space.ledger.state()
        .join(bad, "change_id", "left")
        .select("change_id", "process_id", "start_dtime", "total_records", "status", "reason", "bad")
    )


PROCESSES = 8


@query
def many_processes(spark, sf_dir):
    """Eight processes over parts of the table, four at a time, into one table each; two
    of them lack their first page, which fails their runs alone."""
    root = scratch_path(spark, "many")
    parts = table(spark, sf_dir, "part").withColumn("process_id", F.col("p_partkey") % PROCESSES + 1)
    process, api, bucket = part_config(spark, sf_dir)
    ids = spark.range(1, PROCESSES + 1).select(F.col("id").alias("process_id"))
    first = F.col("process_id") == 1

    def for_all(rows: DataFrame) -> DataFrame:
        return rows.where(first).drop("process_id").crossJoin(F.broadcast(ids)).select(rows.columns)

    bucket = for_all(bucket).withColumn("target_table_nm", F.concat(F.lit("product_"), F.col("process_id").cast("string")))
    body = F.concat(F.lit("<root>"), F.array_join(F.collect_list(data.manifest_record()), ""), F.lit("</root>"))
    pages = parts.groupBy("process_id").agg(body.alias("body")).select(
        "process_id", data.page_url(F.lit(0)).alias("url"), "body"
    )
    inputs = LandedInputs(pages.where("process_id not in (3, 6)"), landed_inputs(spark, sf_dir).payloads)
    results = run(spark, for_all(process), for_all(api), bucket, root, inputs, NOW, parallel=4)
    space = Workspace(spark, root)
    found = None
    for result in results:
        if bool(result.error) != (result.process_id in (3, 6)):
            raise RuntimeError(f"unexpected result: {result}")
        if not result.error:
            rows = product_rows(space.tables.read(f"product_{result.process_id}"))
            rows = rows.withColumn("process_id", F.lit(result.process_id).cast("bigint"))
            found = rows if found is None else found.unionByName(rows)
    states = space.ledger.state().select("process_id", "status", "total_records")
    return states.join(found, "process_id", "left").select("process_id", "status", "total_records", "ean", "title", "size", "price")


class FailingApplier:
    """Stands for a target that can't be written just now."""

    def apply(self, incoming, target, now, expected_rows):
        raise RuntimeError("the target can't be written")


LANDINGS = (datetime(2024, 3, 1), datetime(2024, 4, 1), datetime(2024, 5, 1))


@query
def incremental_runs(spark, sf_dir):
    """Three landings that reuse their urls, one run each; the second run's
    apply fails, and the third run makes up for it."""
    root = scratch_path(spark, "incremental")
    parts = table(spark, sf_dir, "part")
    config = part_config(spark, sf_dir)
    config = (config[0].where("process_id = 1"), *config[1:])
    payloads = landed_inputs(spark, sf_dir).payloads
    pages = None
    for batch, now in enumerate(LANDINGS):
        landed = data.manifest_pages(parts.where(F.col("p_partkey") % 3 == batch)).select(
            "process_id", "url", "body", F.lit(batch).alias("batch")
        )
        pages = landed if pages is None else pages.unionByName(landed)
        inputs = LandedInputs(pages, payloads, page_order="batch")
        (result,) = run(spark, *config, root, inputs, now, FailingApplier() if batch == 1 else None)
        if bool(result.error) != (batch == 1):
            raise RuntimeError(f"unexpected result: {result}")
    return product_rows(Workspace(spark, root).tables.read("product"))


@query
def apply_counts(spark, sf_dir):
    """Counters of the second of two snapshots, some of its payloads unusable."""
    parts = table(spark, sf_dir, "part")
    space = workspace(spark)
    space.archive.append(data.part_archive(parts.where("p_size < 40"), data.full_part_payload(), 1))
    kind = F.col("p_partkey") % 4
    price = F.when(kind == 0, data.amount(F.col("p_retailprice") + 1)).when(kind == 1, data.amount(F.lit("free")))
    second = F.when(kind == 3, "<broken").otherwise(data.part_payload(price=price))
    space.archive.append(data.part_archive(parts.where("p_size >= 20"), second, 2))
    apply_snapshot(space, data.PART_SPEC, 1, NOW)
    result = apply_snapshot(space, data.PART_SPEC, 2, NOW)
    counts = result.actions["product"]
    row = (result.total, result.failed, result.cut, *(counts[a] for a in ("inserted", "updated", "unchanged")))
    return local_rows(spark, "total bigint, failed bigint, cut bigint, inserted bigint, updated bigint, unchanged bigint", [row])


@query
def manifest_key_problems(spark, sf_dir):
    """Records with blank, missing and non-numeric keys, and pages that are none."""
    kind = F.col("p_partkey") % 5
    key = F.when(kind == 0, "").when(kind == 1, "<ean/>").when(kind == 2, element("ean", F.col("p_name")))
    key = key.otherwise(element("ean", F.col("p_partkey")))
    body = F.when(kind == 4, F.concat(F.lit("<root><product>"), key)).otherwise(
        F.concat(F.lit("<root><product>"), key, F.lit("</product></root>"))
    )
    pages = table(spark, sf_dir, "part").select("p_partkey", body.alias("body"))
    records = explode_records(pages, ApiSpec(record_tag="product", key_tag="ean"))
    return records.select("p_partkey", "record_no", "key", "reason")


@query
def sql_functions(spark, sf_dir):
    """The extraction functions called from SQL."""
    register_functions(spark)
    parts = table(spark, sf_dir, "part").select("p_partkey", data.full_part_payload().alias("data"))
    pages = data.manifest_pages(table(spark, sf_dir, "part")).select("body")
    found = spark.sql(
        """
        SELECT CAST(xml_text_at(data, '//main/ean') AS bigint) AS ean, xml_text_at(data, '/product/main/title') AS title,
               xml_body_at(data, '//price') AS price, xml_text_at(data, '//none') AS nothing
        FROM {parts}
        """,
        parts=parts,
    )
    records = spark.sql("SELECT CAST(r.key AS bigint) AS ean, r.body AS record FROM {pages}, LATERAL xml_records(body, 'product', 'ean') r", pages=pages)
    return found.join(records, "ean")


@query
def archive_order(spark, sf_dir):
    """Archive ids ascend in manifest order: rank by id against the part key."""
    space = workspace(spark)
    pages = data.manifest_pages(table(spark, sf_dir, "part"))
    change_id = space.ledger.open_run(1, NOW)
    base = space.ledger.reserve_pages(change_id, 1, NOW, 1)
    records = explode_records(pages, data.MANIFEST_API, data.PART_API)
    archive_records(space, data.PART_SPEC, change_id, records, base, NOW, landed_inputs(spark, sf_dir))
    archived = space.archive.read(change_id)
    by_page = F.shiftright("id", 29)
    place = F.row_number().over(Window.partitionBy(by_page).orderBy("id"))
    return archived.select("ean", by_page.alias("page_no"), place.alias("place"), "notification", "data")


@query
def stream_archived(spark, sf_dir):
    """Page files archived by a stream."""
    space = workspace(spark)
    landed = f"{space.root}/landed"
    pages = data.manifest_pages(table(spark, sf_dir, "part"))
    pages.select("process_id", "page_no", "url", "body").write.parquet(landed)
    change_id = space.ledger.open_run(1, NOW)
    inputs = landed_inputs(spark, sf_dir)
    stream = stream_archive(
        spark, landed, space, data.PART_SPEC, inputs, change_id, NOW, f"{space.root}/checkpoint-pages", 2
    )
    finish_run(stream, space, data.PART_SPEC, change_id, NOW)
    return space.archive.read(change_id).select("ean", "data")


def two_snapshots(spark, sf_dir) -> list[tuple[DataFrame, datetime]]:
    """The archive rows of ``apply_parts`` with the time of their run."""
    parts = table(spark, sf_dir, "part")
    kind = F.col("p_partkey") % 4
    title = F.when(kind == 0, element("title", F.upper("p_name"))).when(kind == 1, "<title/>").otherwise("")
    price = F.when(kind == 2, data.amount(F.col("p_retailprice") + 1))
    first = data.part_archive(parts.where("p_size < 40"), data.full_part_payload(), 1)
    second = data.part_archive(parts.where("p_size >= 20"), data.part_payload(title, price), 2)
    return [(first, datetime(2024, 1, 1)), (second, NOW)]


@query
def stream_applied(spark, sf_dir):
    """The same two snapshots as ``apply_parts``, applied by a stream."""
    space = workspace(spark)
    for archived, now in two_snapshots(spark, sf_dir):
        space.ledger.open_run(1, now)
        space.archive.append(archived)
        stream_apply(spark, space, data.PART_SPEC, now, f"{space.root}/checkpoint-apply").awaitTermination()
    return product_rows(space.tables.read("product"))


@query
def stream_replayed(spark, sf_dir):
    """``stream_applied`` with its last batch run again, as after a lost driver: the
    batch is in the version log already, so no version is added."""
    space = workspace(spark)
    checkpoint = f"{space.root}/checkpoint-apply"
    for archived, now in two_snapshots(spark, sf_dir):
        change_id = space.ledger.open_run(1, now)
        space.archive.append(archived)
        space.ledger.complete(change_id, 1, now, archived.count())
        stream_apply(spark, space, data.PART_SPEC, now, checkpoint).awaitTermination()
    forget_commit(spark, checkpoint, 1)
    stream_apply(spark, space, data.PART_SPEC, LATER, checkpoint).awaitTermination()
    version = space.tables.current("product").number
    waiting = len(space.ledger.unapplied(1))
    rows = product_rows(space.tables.read("product"))
    return rows.select("*", F.lit(version).alias("versions"), F.lit(waiting).alias("runs_to_apply"))


def forget_commit(spark: SparkSession, checkpoint: str, batch_id: int) -> None:
    """Undo the note that a stream's batch was done, which makes it run again."""
    for name in (f"{batch_id}", f".{batch_id}.crc"):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


# --- live inputs, resumed and windowed runs -----------------------------


def live_service(spark, sf_dir, root: str) -> transport.TableTransport:
    """Pages and payloads of the parts behind urls; parts of size 7 have no payload."""
    parts = table(spark, sf_dir, "part")
    pages = data.manifest_pages(parts).select("url", "body")
    payload_url = F.concat(F.lit(f"{data.PART_API.base_url}?detail=full&part="), F.col("p_partkey").cast("string"))
    payloads = parts.where("p_size <> 7").select(payload_url.alias("url"), data.full_part_payload().alias("body"))
    return transport.publish(pages.unionByName(payloads), f"{root}/service")


@query
def live_payloads(spark, sf_dir):
    """Pages and payloads pulled from a service; a payload that fails is archived as an error."""
    space = workspace(spark)
    inputs = LiveInputs(live_service(spark, sf_dir, space.root), segment_pages=16)
    change_id = pull(spark, space, data.PART_SPEC, inputs, NOW)
    return run_rows(space, change_id)


def run_rows(space: Workspace, change_id: int) -> DataFrame:
    """Archived rows of a run beside its ledger row."""
    run_state = space.ledger.state().select("change_id", "status", "total_records")
    return space.archive.read(change_id).join(run_state, "change_id").select("change_id", "ean", "data", "status", "total_records")


@query
def stream_pulled(spark, sf_dir):
    """A live manifest as a stream, stopped after every segment and started again."""
    space = workspace(spark)
    service = live_service(spark, sf_dir, space.root)
    change_id = space.ledger.open_run(1, NOW)
    parts = table(spark, sf_dir, "part").agg(F.max("p_partkey")).first()[0] or 0
    segment = parts // data.PAGE_ROWS // 3 + 1
    while True:
        stream = stream_pull(
            spark, service, space, data.PART_SPEC, LiveInputs(service), change_id, NOW, f"{space.root}/checkpoint-pull",
            segment_pages=segment,
        )
        stream.awaitTermination()
        if not space.ledger.resume_point(1)["last_anchor"]:
            break
    finish_run(stream, space, data.PART_SPEC, change_id, NOW)
    return run_rows(space, change_id)


@query
def resumed_run(spark, sf_dir):
    """A page in the middle of the chain is landed late: the run fails there, keeps its
    anchor, and goes on under its id once the page is there."""
    space = workspace(spark)
    inputs = landed_inputs(spark, sf_dir)
    pages = inputs.pages
    count = pages.count()
    late = data.page_url(F.lit(count // 2))
    outcomes = []
    for landed, now in ((pages.where(F.col("url") != late), BEFORE), (pages, NOW)):
        try:
            pull(spark, space, data.PART_SPEC, LandedInputs(landed, inputs.payloads), now)
            outcomes.append("complete")
        except PageNotLanded:
            outcomes.append("failed")
    events = space.ledger.events()
    anchored = events.where(F.col("status") == "F").agg(F.max("last_anchor").alias("failed_at"))
    tried = F.lit(",".join(outcomes)).alias("outcomes")
    return run_rows(space, 1).crossJoin(F.broadcast(anchored)).select("*", tried)


WINDOWS = ((datetime(2024, 3, 1), None), (datetime(2024, 4, 1), None), (datetime(2024, 5, 1), "10d"))
OVERLAP = timedelta(minutes=15)


@query
def windowed_run(spark, sf_dir):
    """Three runs, each of which asks for what changed in its window: first 30 days,
    then since the last start, then the configured 10 days. The pages of other
    windows are not landed, so a wrong window fails its run."""
    root = scratch_path(spark, "windowed")
    parts = table(spark, sf_dir, "part")
    changed = F.lit("2024-01-01 12:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("p_partkey") % 140).cast("int"))
    last = WINDOWS[0][0] - timedelta(days=30)
    for now, configured in WINDOWS:
        since = now - timedelta(days=10) if configured else last - OVERLAP
        stamp = (since - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
        mine = parts.where((changed >= F.lit(since).cast("timestamp_ntz")) & (changed < F.lit(now).cast("timestamp_ntz")))
        body = F.concat(F.lit("<root>"), F.array_join(F.collect_list(data.manifest_record()), ""), F.lit("</root>"))
        chunks = mine.groupBy((F.col("p_partkey") % 7).alias("chunk")).agg(body.alias("body"))
        following = F.when(F.col("chunk") < 6, F.concat(F.lit(f"{data.BASE_URL}?chunk={stamp}."), (F.col("chunk") + 1).cast("string")))
        pages = chunks.select(
            F.lit(1).cast("bigint").alias("process_id"),
            F.when(F.col("chunk") == 0, f"{data.BASE_URL}?list=spares&since={stamp}")
            .otherwise(F.concat(F.lit(f"{data.BASE_URL}?chunk={stamp}."), F.col("chunk").cast("string")))
            .alias("url"),
            F.replace(
                F.col("body"),
                F.lit("<root>"),
                F.concat(F.lit("<root>"), element("remaining", following.isNotNull()), element("cursor", F.coalesce(following, F.lit("")))),
            ).alias("body"),
        )
        config = part_config(spark, sf_dir)
        args = "list=spares" + (f",since={configured}" if configured else "")
        is_change = (F.col("process_id") == 1) & (F.col("api_type") == "C")
        apis = config[1].withColumns(
            {
                "since_url_arg_nm": F.when(is_change, "since"),
                "request_filter_args": F.when(is_change, args).otherwise(F.col("request_filter_args")),
            }
        )
        inputs = LandedInputs(pages, landed_inputs(spark, sf_dir).payloads)
        (result,) = run(spark, config[0].where("process_id = 1"), apis, config[2], root, inputs, now)
        if result.error:
            raise RuntimeError(f"run failed: {result}")
        last = now
    return product_rows(Workspace(spark, root).tables.read("product"))
