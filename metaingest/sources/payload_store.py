"""Landed payloads, laid out by key, so that a lookup moves none that it does not want."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TableStore

TABLE = "payloads"
BODIES_PER_BUCKET = 200_000


class PayloadStore:
    """Payloads below ``<root>``: ``key``, ``body`` and ``landed``, the number of their landing.

    The files are bucketed by key and a landing adds files to the buckets. Which
    landing is a key's newest is found from the narrow columns, where the rows lie,
    and only then are the bodies of the newest ones read, from the same buckets.
    """

    def __init__(self, spark: SparkSession, root: str, bodies_per_bucket: int = BODIES_PER_BUCKET):
        self.spark = spark
        self.tables = TableStore(spark, root, bodies_per_bucket)

    def land(self, payloads: DataFrame) -> int:
        """Add (``key``, ``body``) rows as the next landing and return its number.

        Readers see all of a landing or nothing of it. A key that is landed twice at
        once is refused. The number of buckets is set by the first landing, or given
        anew by ``spread_out``.
        """
        version = self.tables.current(TABLE)
        landing = version.number + 1 if version else 1
        repeated = payloads.groupBy("key").count().where("count > 1").first()
        if repeated is not None:
            raise ValueError(f"payload landed more than once: {repeated['key']}")
        buckets = version.buckets if version else self.tables.bucket_count(payloads.count(), None)
        rows = payloads.select(F.col("key").cast("string").alias("key"), F.lit(landing).cast("bigint").alias("landed"), "body")
        placed = self.tables.layout(rows, ["key"], buckets)
        so_far = version.rows if version else 0
        self.tables.write(TABLE, placed, ["key"], buckets, lambda: so_far, version, adds=True)
        return landing

    def spread_out(self, buckets: int) -> None:
        """Lay all payloads out anew over so many buckets, keeping their landings."""
        version = self.tables.current(TABLE)
        if version is not None and version.buckets != buckets:
            rows = self.tables.layout(self.tables.read_version(version), ["key"], buckets)
            self.tables.write(TABLE, rows, ["key"], buckets, lambda: version.rows, version)

    def newest(self, wanted: DataFrame) -> DataFrame:
        """``key`` and ``body`` of the newest landing of every wanted key that was landed.

        ``wanted`` has a column ``key``. Its distinct keys are moved to the buckets;
        stored rows stay where they are."""
        version = self.tables.current(TABLE)
        if version is None:
            return wanted.select("key", F.lit(None).cast("string").alias("body")).where(F.lit(False))
        stored = self.tables.read_version(version)
        keys = self.tables.layout(wanted.select(F.col("key").cast("string").alias("key")).distinct(), ["key"], version.buckets)
        narrow = stored.select("key", "landed").join(keys, "key", "left_semi")
        latest = narrow.groupBy("key").agg(F.max("landed").alias("latest")).toDF("latest_key", "latest")
        # No landing is later than the latest; "at least" keeps the join on the key alone,
        # which is what the files are laid out by.
        found = stored.join(latest, (F.col("key") == F.col("latest_key")) & (F.col("landed") >= F.col("latest")))
        return found.select("key", "body")
