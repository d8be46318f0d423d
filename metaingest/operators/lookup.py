"""Payload lookup for manifest records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: archived in place of a payload that could not be fetched.
ERROR_ENVELOPE = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    "<response><errors><error><description>General problem with the data URL.</description></error></errors></response>"
)


def check_unique_keys(payloads: DataFrame, wanted: DataFrame, key: str = "key") -> None:
    """Raise ``ValueError`` if a key that ``wanted`` has was landed more than once. Reads keys only."""
    mine = payloads.select(key).join(wanted.select(key), key, "left_semi")
    repeated = mine.groupBy(key).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"payload landed more than once and no landing order is known: {repeated[key]}")


def lookup_payloads(
    manifest: DataFrame, payloads: DataFrame, key: str = "key", body: str = "body", landed_order: str | None = None
) -> DataFrame:
    """Add ``data``: the payload with the record's key, else the error envelope.

    Payload keys must be unique (``check_unique_keys``) unless ``landed_order``
    names a column by which the latest one wins. The join is a left one with the manifest on the
    preserved side, so Spark splits a hot key at run time without losing rows.
    """
    if landed_order is None:
        right = payloads.select(F.col(key).alias("_payload_key"), F.col(body).alias("data"))
    else:
        right = payloads.groupBy(F.col(key).alias("_payload_key")).agg(
            F.max_by(F.col(body), F.col(landed_order)).alias("data")
        )
    joined = manifest.join(right, manifest["key"] == right["_payload_key"], "left").drop("_payload_key")
    return joined.withColumn("data", F.coalesce("data", F.lit(ERROR_ENVELOPE)))
