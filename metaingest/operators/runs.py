"""Questions about earlier runs, asked of a ledger with one row per run.

Ledger columns used: process_id, change_id, status, start_dtime, last_anchor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import default_start

PENDING, FAILED, COMPLETED = "P", "F", "C"


def last_run(ledger: DataFrame, *statuses: str, where: Column | None = None) -> DataFrame:
    """Per process, the run with the highest id among the given statuses."""
    runs = ledger.where(F.col("status").isin(*statuses))
    if where is not None:
        runs = runs.where(where)
    row = F.struct(*[c for c in ledger.columns if c != "process_id"])
    return runs.groupBy("process_id").agg(F.max_by(row, "change_id").alias("run")).select("process_id", "run.*")


def resume_candidate(ledger: DataFrame) -> DataFrame:
    """Per process, the latest run that failed or never finished."""
    return last_run(ledger, FAILED, PENDING).select("process_id", "change_id", "last_anchor")


def incremental_start(ledger: DataFrame, processes: DataFrame, now: Column) -> DataFrame:
    """Per process, where the next incremental run starts.

    The last completed start, unless a newer failed run left an anchor: then
    that run's start and anchor. Without any run, 30 days before now.
    One pass over the ledger finds both runs.
    """

    def latest(status: str) -> Column:
        run = F.struct("start_dtime", "last_anchor")
        return F.max_by(run, F.when(F.col("status") == status, F.col("change_id")))

    runs = ledger.groupBy("process_id").agg(latest(COMPLETED).alias("done"), latest(FAILED).alias("failed"))
    joined = processes.select("process_id").join(runs, "process_id", "left")
    done = default_start("done.start_dtime", now)
    failed = default_start("failed.start_dtime", now)
    resumes = (failed > done) & (F.coalesce(F.col("failed.last_anchor"), F.lit("")) != "")
    return joined.select(
        "process_id",
        F.when(resumes, failed).otherwise(done).alias("start_dtime"),
        F.when(resumes, F.col("failed.last_anchor")).alias("last_anchor"),
    )
