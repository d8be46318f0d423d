"""Live payloads: fetched on the executors that hold the manifest records."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls
from ..operators.lookup import ERROR_ENVELOPE
from ..specs import ApiSpec
from .pages import Transport, fetch_with_retries


def with_request_url(manifest: DataFrame, api: ApiSpec) -> DataFrame:
    """Add ``request_url`` built from the record's final arguments."""
    return manifest.withColumn("request_url", urls.format_url(F.lit(api.base_url), "args"))


def fetch_payloads(manifest: DataFrame, api: ApiSpec, transport: Transport, attempts: int = 3, pause: float = 0.0) -> DataFrame:
    """Add ``data`` by fetching each record's url; a failure gives the error envelope.

    The keys never leave their partitions, so the work grows with the cluster.
    """
    requests = with_request_url(manifest, api).drop("args")
    schema = T.StructType(list(requests.drop("request_url").schema) + [T.StructField("data", T.StringType())])
    headers = dict(api.header_args)

    def fetch(url: str) -> str:
        try:
            return fetch_with_retries(transport, url, headers, attempts, pause)
        except Exception:  # whatever the transport raises, one record must not end the run
            return ERROR_ENVELOPE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = pa.array(map(fetch, batch.column("request_url").to_pylist()), pa.string())
            kept = [n for n in batch.schema.names if n != "request_url"]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + [bodies], kept + ["data"])

    return requests.mapInArrow(run, schema)
