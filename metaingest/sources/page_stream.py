"""A live manifest as a stream whose offset is the anchor of the next page."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ..specs import ApiSpec
from .pages import PAGE_SCHEMA, Transport, fetch_with_retries, next_page_url, registering


def walk(transport: Transport, api: ApiSpec, url: str | None, page_no: int, attempts: int, pause: float) -> Iterator[tuple]:
    """Pages of a chain from a url on: (page_no, url, body, next_url). A page that
    leads to itself ends it."""
    while url:
        body = fetch_with_retries(transport, url, api.header_args, attempts, pause)
        following = next_page_url(api, body)
        following = None if following == url else following
        yield page_no, url, body, following
        url, page_no = following, page_no + 1


def page_stream(
    spark: SparkSession,
    transport: Transport,
    process_id: int,
    api: ApiSpec,
    start_url: str,
    segment_pages: int = 100,
    attempts: int = 3,
    pause: float = 0.0,
) -> DataFrame:
    """Streaming pages (process_id, page_no, url, body, next_url).

    A page names the next one, so a chain is walked one page at a time; a batch
    holds a segment of at most ``segment_pages``. The offset is the url of the page
    to read next, with its number; at the chain's end it has no url and no more
    pages come. A batch that runs again walks from its first anchor to its last.
    """
    if segment_pages < 1:
        raise ValueError("segment_pages must be positive")

    class Reader(SimpleDataSourceStreamReader):
        def initialOffset(self):
            return {"url": start_url, "page_no": 0}

        def read(self, start):
            rows = []
            for page_no, url, body, following in walk(transport, api, start["url"], start["page_no"], attempts, pause):
                rows.append((process_id, page_no, url, body, following))
                start = {"url": following, "page_no": page_no + 1}
                if len(rows) == segment_pages:
                    break
            return iter(rows), start

        def readBetweenOffsets(self, start, end):
            for page_no, url, body, following in walk(transport, api, start["url"], start["page_no"], attempts, pause):
                if page_no >= end["page_no"]:
                    return
                yield process_id, page_no, url, body, following

        def commit(self, end):
            """Archiving a batch notes its anchor in the ledger; nothing is held here."""

    class ManifestStream(DataSource):
        @classmethod
        def name(cls):
            return "manifest_stream"

        def schema(self):
            return PAGE_SCHEMA

        def simpleStreamReader(self, schema):
            return Reader()

    with registering:
        spark.dataSource.register(ManifestStream)
        return spark.readStream.format("manifest_stream").load()
