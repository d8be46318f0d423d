"""Engine inputs derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import xml_text
from ..session import spread
from ..specs import ApiSpec, BucketSpec, ColumnSpec, ProcessSpec

BASE_URL = "http://catalog.example/products"
PAGE_ROWS = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def element(tag: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), xml_text(value.cast("string")), F.lit(f"</{tag}>"))


PART_COLUMNS = (
    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
    ColumnSpec("title", "//main/title", "Varchar2", 500),
    ColumnSpec("size", "//main/size", "Int32"),
)
PRICE_COLUMNS = (
    ColumnSpec("ean", "//main/ean", "Int64", is_key=True),
    ColumnSpec("price", "/product/price/amount", "Double"),
)
PART_API = ApiSpec(
    base_url="http://catalog.example/product",
    request_args={"detail": "full", "part": "//product/ean"},
    buckets=(
        BucketSpec("main", "product", PART_COLUMNS),
        BucketSpec("price", "product", PRICE_COLUMNS),
        BucketSpec("availability"),
    ),
)
MANIFEST_API = ApiSpec(
    base_url=BASE_URL,
    anchor_indicator="remaining",
    anchor_element="cursor",
    anchor_args={"list": "spares"},
    request_args={"list": "spares"},
    response_filter="//market[. != 'ASIA']",
    record_tag="product",
    key_tag="ean",
)
PART_SPEC = ProcessSpec(1, "parts", MANIFEST_API, PART_API)

LINE_SPEC = ProcessSpec(
    2,
    "lines",
    ApiSpec(),
    ApiSpec(
        buckets=(
            BucketSpec(
                "line",
                "order_line",
                (
                    ColumnSpec("order_id", "/line/order", "Int64", is_key=True),
                    ColumnSpec("line_no", "/line/no", "Int32", is_key=True),
                    ColumnSpec("quantity", "/line/quantity", "Double"),
                    ColumnSpec("price", "/line/price", "Double"),
                    ColumnSpec("flag", "/line/flag", "Varchar2", 1),
                    ColumnSpec("shipped", "/line/shipped", "DateTime"),
                ),
            ),
        )
    ),
)


def part_payload(title: Column | None = None, price: Column | None = None) -> Column:
    """``<product>`` document of a part; null pieces are left out."""
    title = element("title", F.col("p_name")) if title is None else title
    price = element("price", F.lit(None)) if price is None else price
    return F.concat(
        F.lit("<product><main>"),
        element("ean", F.col("p_partkey")),
        F.coalesce(title, F.lit("")),
        element("size", F.col("p_size")),
        F.lit("</main>"),
        F.coalesce(price, F.lit("")),
        F.lit("</product>"),
    )


def amount(value: Column) -> Column:
    return F.concat(F.lit("<price>"), element("amount", value), F.lit("</price>"))


def full_part_payload() -> Column:
    return part_payload(price=amount(F.col("p_retailprice")))


def part_archive(parts: DataFrame, data: Column, change_id: int = 1) -> DataFrame:
    """Archive rows with the part key as id."""
    return spread(parts).select(
        F.col("p_partkey").alias("id"),
        F.col("p_partkey").alias("ean"),
        F.lit("").alias("notification"),
        data.alias("data"),
        *[F.lit("2024-01-01").cast("timestamp_ntz").alias(c) for c in ("add_dtime", "upd_dtime")],
        F.lit(change_id).cast("bigint").alias("change_id"),
    )


def market() -> Column:
    return F.when(F.col("p_size") % 3 == 0, "EU").when(F.col("p_size") % 3 == 1, "").otherwise("ASIA")


def manifest_record() -> Column:
    """``<product>`` manifest record of a part, with a repeated bucket value."""
    return F.concat(
        F.lit("<product>"),
        element("ean", F.col("p_partkey")),
        element("group", F.col("p_type")),
        F.lit("<group/>"),
        element("group", F.col("p_brand")),
        element("group", F.col("p_type")),
        F.lit("<sold>"),
        element("market", market()),
        F.lit("</sold></product>"),
    )


def page_url(page: Column) -> Column:
    """Url of a page: the first one is the request, others are anchors."""
    return F.when(page == 0, f"{BASE_URL}?list=spares").otherwise(
        F.concat(F.lit(f"{BASE_URL}?list=spares&page="), page.cast("string"))
    )


def manifest_pages(parts: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Linked pages of manifest records: (process_id, page_no, url, body).

    Each page also nests a record below another element, which is not a
    record of the page.
    """
    rows = parts.select(
        F.floor(F.col("p_partkey") / page_rows).alias("page_no"), "p_partkey", manifest_record().alias("record")
    )
    pages = rows.groupBy("page_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "record"))), lambda r: r["record"]), "").alias("records")
    )
    followed = parts.select((F.floor(F.col("p_partkey") / page_rows) - 1).alias("page_no"), F.lit(True).alias("more")).distinct()
    more = F.col("more").isNotNull()
    following = F.concat(F.lit("&page="), (F.col("page_no") + 1).cast("string"))
    body = F.concat(
        F.lit("<root>"),
        element("remaining", F.when(more, "true").otherwise("false")),
        element("cursor", F.when(more, following).otherwise("")),
        F.col("records"),
        F.lit("<deep><product><ean>1</ean></product></deep></root>"),
    )
    return pages.join(followed, "page_no", "left").select(
        F.lit(1).cast("bigint").alias("process_id"), "page_no", page_url(F.col("page_no")).alias("url"), body.alias("body")
    )


def line_archive(lines: DataFrame) -> DataFrame:
    """Archive rows of order lines: compound keys, some of them repeated."""
    data = F.concat(
        F.lit("<line>"),
        element("order", F.col("l_orderkey")),
        element("no", F.col("l_linenumber")),
        element("quantity", F.col("l_quantity")),
        element("price", F.col("l_extendedprice")),
        element("flag", F.col("l_returnflag")),
        element("shipped", F.col("l_shipdate")),
        F.lit("</line>"),
    )
    return spread(lines).select(
        (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 10_000_000 + F.col("l_partkey")).alias("id"),
        F.lit(None).cast("bigint").alias("ean"),
        data.alias("data"),
        F.lit(1).cast("bigint").alias("change_id"),
    )
