"""Everything a run reads and writes besides its inputs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..sources.archive import Archive, Quarantine
from ..sources.ledger import Ledger
from ..sources.tables import TableStore


class Workspace:
    """Ledger, archive, quarantine and target tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.ledger = Ledger(spark, self.root)
        self.archive = Archive(spark, self.root)
        self.quarantine = Quarantine(spark, self.root)
        self.tables = TableStore(spark, self.root)
