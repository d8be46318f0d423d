"""Manifest pages: landed ones in chain order, live ones through a data source."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import _trees as trees
from ..functions import urls
from ..functions.documents import page_links
from ..functions.minilang import is_true_text
from ..session import local_rows, stage, stage_counted
from ..specs import ApiSpec

Transport = Callable[[str, dict[str, str]], str]

PAGE_KEYS = ("process_id", "url")
DOUBLINGS_PER_ROUND = 2
#: Data sources are registered by name for the whole session: another thread must not come between.
registering = threading.Lock()


def string_map(values: dict[str, str]):
    if not values:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def next_links(pages: DataFrame, api: ApiSpec, body: str = "body") -> DataFrame:
    """(process_id, url, next_url) of each page; null on the last page.

    Without a configured indicator every page is the last one.
    """
    link = page_links(body, api.anchor_indicator, api.anchor_element, api.content_type)
    linked = pages.select(*PAGE_KEYS, link.alias("_link"))
    following = F.when(
        is_true_text("_link.indicator"),
        urls.anchor_url(F.lit(api.base_url), string_map(api.anchor_args), "_link.anchor"),
    )
    return linked.select(*PAGE_KEYS, following.alias("next_url"))


def chain_positions(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(process_id, url, page_no) of the pages reachable from the start urls.

    Following one link at a time would take as many jobs as there are pages.
    Here each step doubles the stride: links are joined to themselves to skip
    twice as far, so n pages take about log2(n) steps, two of them per written
    round. A page that is reached twice keeps its first position, which also
    ends cycles. Urls must be unique per process.
    """
    links = stage(links, "page-links")
    repeated = links.groupBy(*PAGE_KEYS).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"page landed twice for process {repeated['process_id']}: {repeated['url']}")
    reached = starts.select(*PAGE_KEYS, F.lit(0).cast("bigint").alias("page_no")).distinct()
    jumps = links.where(F.col("next_url").isNotNull())
    known, stride = 0, 1
    while True:
        for _ in range(DOUBLINGS_PER_ROUND):
            ahead = reached.join(jumps, list(PAGE_KEYS)).select(
                "process_id", F.col("next_url").alias("url"), (F.col("page_no") + stride).alias("page_no")
            )
            onward = jumps.select("process_id", F.col("url").alias("next_url"), F.col("next_url").alias("onward"))
            reached = reached.unionByName(ahead)
            jumps = jumps.join(onward, ["process_id", "next_url"]).select(
                *PAGE_KEYS, F.col("onward").alias("next_url")
            )
            stride *= 2
        # One staged table per round holds both: pages with a number, and jumps.
        round_rows, seen = stage_counted(
            reached.groupBy(*PAGE_KEYS)
            .agg(F.min("page_no").alias("page_no"))
            .withColumn("next_url", F.lit(None).cast("string"))
            .unionByName(jumps.withColumn("page_no", F.lit(None).cast("bigint"))),
            "page-chain",
            pages=F.count("page_no"),
        )
        reached = round_rows.where(F.col("page_no").isNotNull()).drop("next_url")
        jumps = round_rows.where(F.col("next_url").isNotNull()).drop("page_no")
        no_jumps_left = seen["pages"] == seen["rows"]
        if no_jumps_left or seen["pages"] == known:
            return reached
        known = seen["pages"]


class _ChainPartition(InputPartition):
    def __init__(self, process_id: int, api: ApiSpec, url: str):
        super().__init__((process_id, url))
        self.process_id, self.api, self.url = process_id, api, url


def next_page_url(api: ApiSpec, body: str) -> str | None:
    """Next url named by one page body, as ``next_links`` gives it."""
    document = trees.parse_document(body, api.content_type == "JSON")
    if document is None or not api.anchor_indicator:
        return None
    root = document[0]
    if (trees.child_text(root, api.anchor_indicator) or "").lower() != "true":
        return None
    anchor = trees.child_text(root, api.anchor_element) or ""
    if not anchor:
        return None
    return anchor if anchor.lower().startswith("http") else plain_url(api.base_url, api.anchor_args) + anchor


def plain_url(base: str, args: dict[str, str]) -> str:
    query = "&".join(f"{k}={v}" for k, v in args.items() if v)
    return f"{base}?{query}" if query else base


def fetch_with_retries(transport: Transport, url: str, headers: dict[str, str], attempts: int, pause: float = 0.0) -> str:
    """The body, or the last attempt's error, of whatever kind it is; ``pause`` in seconds between attempts."""
    for attempt in range(attempts):
        try:
            return transport(url, headers)
        except Exception:
            if attempt + 1 == attempts:
                raise
            time.sleep(pause)
    raise ValueError("attempts must be positive")


def manifest_pages(
    spark: SparkSession,
    transport: Transport,
    chains: list[tuple[int, ApiSpec, str]],
    max_pages: int | None = None,
    attempts: int = 3,
    pause: float = 0.0,
    keep_pulled: bool = False,
) -> DataFrame:
    """Live pages (process_id, page_no, url, body, next_url).

    Each chain is one input partition and is walked on an executor, page by
    page, since every page names the next. ``transport(url, headers)`` must
    pickle. ``max_pages`` ends a chain early; its last ``next_url`` continues. So
    does a page that fails with ``keep_pulled``, unless it is a chain's first.
    """
    if not chains:
        return local_rows(spark, PAGE_SCHEMA)

    class Reader(DataSourceReader):
        def partitions(self):
            return [_ChainPartition(*chain) for chain in chains]

        def read(self, partition):
            url, page_no, seen = partition.url, 0, set()
            while url and url not in seen and (max_pages is None or page_no < max_pages):
                seen.add(url)
                try:
                    body = fetch_with_retries(transport, url, partition.api.header_args, attempts, pause)
                except Exception:
                    if keep_pulled and page_no:
                        return
                    raise
                following = next_page_url(partition.api, body)
                yield partition.process_id, page_no, url, body, following
                url, page_no = following, page_no + 1

    class ManifestPages(DataSource):
        @classmethod
        def name(cls):
            return "manifest_pages"

        def schema(self):
            return PAGE_SCHEMA

        def reader(self, schema):
            return Reader()

    with registering:
        spark.dataSource.register(ManifestPages)
        return spark.read.format("manifest_pages").load()


PAGE_SCHEMA = "process_id bigint, page_no bigint, url string, body string, next_url string"
