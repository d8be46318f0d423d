"""Where a run gets its pages and payloads from."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import check_unique_keys, lookup_payloads
from ..session import dealt, local_rows, spread, stage_counted
from ..sources.pages import Transport, chain_positions, manifest_pages, next_links
from ..sources.payload_store import PayloadStore
from ..sources.payloads import fetch_payloads
from ..specs import ApiSpec, ProcessSpec

# Keys are broadcast only when their measured size is below this.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024


class PageNotLanded(LookupError):
    """A run needs a page that is not there, so it can't be complete."""

    def __init__(self, process_id: int, url: str):
        super().__init__(f"page not landed for process {process_id}: {url}")


@dataclass
class LandedInputs:
    """Pages and payloads that were landed as tables.

    ``pages``: process_id, url, body, and optionally ``page_no`` and a column
    named by ``page_order`` (such as a landing batch), by which the latest page
    of a url counts. With page numbers the order is known, pages are read from
    the start url on, and no chain has to be followed. A start url that was not
    landed fails the run; where a chain leads to such a page, what comes before
    is archived and the run fails at that page, to go on there later.
    ``payloads``: key, body, and optionally a column named by ``landed_order``; or a
    ``PayloadStore``, of which the newest landing of each key counts.
    """

    pages: DataFrame | None = None
    payloads: DataFrame | PayloadStore | None = None
    key_table: Callable[[str], DataFrame] | None = None
    landed_order: str | None = None
    page_order: str | None = None

    def _pages_of(self, process_id: int) -> DataFrame:
        mine = self.pages.where(F.col("process_id") == process_id)
        if self.page_order is None:
            return mine
        newest = mine.groupBy("url").agg(F.max(self.page_order).alias(self.page_order))
        return mine.join(newest, ["url", self.page_order]).drop(self.page_order)

    def page_batches(self, spark: SparkSession, spec: ProcessSpec, start_url: str):
        """Yields (pages with page_no, anchor to continue from or None)."""
        mine = self._pages_of(spec.process_id)
        if "page_no" in mine.columns:
            first = mine.where(F.col("url") == start_url).agg(F.min("page_no")).first()[0]
            if first is None:
                raise PageNotLanded(spec.process_id, start_url)
            yield mine.where(F.col("page_no") >= first), None
            return
        starts = local_rows(spark, "process_id bigint, url string", [(spec.process_id, start_url)])
        positions = chain_positions(next_links(mine, spec.change_api), starts)
        gap = positions.join(mine.select("url"), "url", "left_anti").select("url", "page_no").first()
        if gap is None:
            yield dealt(mine.join(positions, ["process_id", "url"]), "page_no"), None
            return
        if gap["page_no"] > 0:
            yield dealt(mine.join(positions, ["process_id", "url"]), "page_no"), gap["url"]
        raise PageNotLanded(spec.process_id, gap["url"])

    def add_payloads(self, manifest: DataFrame, api: ApiSpec, key_bytes: int) -> DataFrame:
        payloads = self.payloads
        if isinstance(payloads, PayloadStore):
            return lookup_payloads(manifest, payloads.newest(manifest)).drop("args")
        if self.landed_order is None:
            check_unique_keys(payloads, manifest)
        if key_bytes <= BROADCAST_KEY_BYTES:
            # Few records against a large payload table: drop other payloads
            # while scanning, so that only wanted bodies are shuffled.
            payloads = payloads.join(F.broadcast(manifest.select("key").distinct()), "key", "left_semi")
        return lookup_payloads(manifest, payloads, landed_order=self.landed_order).drop("args")


@dataclass
class LiveInputs:
    """Pages and payloads pulled through a transport ``(url, headers) -> body``.

    A chain is pulled in segments; the anchor is saved after each one is
    archived, so a failed run continues from the last archived segment. The first
    has ``segment_pages``, each further one as many as all before it, so a chain of
    n pages takes about log2(n) segments. A page that fails ends a segment before it.
    """

    transport: Transport
    key_table: Callable[[str], DataFrame] | None = None
    segment_pages: int = 1000

    def page_batches(self, spark: SparkSession, spec: ProcessSpec, start_url: str):
        url: str | None = start_url
        seen: set[str] = set()
        pulled = 0
        while url and url not in seen:
            seen.add(url)
            chain = [(spec.process_id, spec.change_api, url)]
            live = manifest_pages(spark, self.transport, chain, max(pulled, self.segment_pages), keep_pulled=True)
            pages, counts = stage_counted(live, "live-pages")
            pulled += counts["rows"]
            last = pages.agg(F.max_by(F.struct("next_url"), "page_no").alias("last")).first()["last"]
            url = last["next_url"] if last else None
            yield spread(pages.drop("next_url"), "page_no"), url

    def add_payloads(self, manifest: DataFrame, api: ApiSpec, key_bytes: int) -> DataFrame:
        return fetch_payloads(spread(manifest), api, self.transport)
