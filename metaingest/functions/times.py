"""Time windows of incremental runs. Times are zone-less and read as UTC.

``now`` is always an argument, so a plan gives the same answer each time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col

# Overlap with the previous run, and the window of a first run.
OVERLAP_MINUTES = 15
DEFAULT_WINDOW_DAYS = 30


def timestamp(value) -> Column:
    """Literal, text or column as a zone-less timestamp."""
    column = value if isinstance(value, Column) else F.lit(str(value))
    return column.cast("timestamp_ntz")


def relative_days(text: ColumnLike) -> Column:
    """Number of days in ``Nd``, null for any other text."""
    return F.regexp_extract(as_col(text), r"^(\d+)d$", 1).try_cast("int")


def days_before(now: Column, days: ColumnLike) -> Column:
    return timestamp(now) - F.make_dt_interval(as_col(days))


def epoch_millis(ts: ColumnLike) -> Column:
    """Whole milliseconds since 1970-01-01, independent of the session zone."""
    return F.timestamp_diff("MILLISECOND", timestamp("1970-01-01 00:00:00"), as_col(ts).cast("timestamp_ntz"))


def overlap_start(ts: ColumnLike) -> Column:
    """Start of the next window: 15 minutes before the given start."""
    return as_col(ts).cast("timestamp_ntz") - F.make_dt_interval(mins=F.lit(OVERLAP_MINUTES))


def default_start(ts: ColumnLike, now: Column) -> Column:
    """The given start, or 30 days before now when there was no run."""
    return F.coalesce(as_col(ts).cast("timestamp_ntz"), days_before(now, F.lit(DEFAULT_WINDOW_DAYS)))


def since_millis(since_arg: ColumnLike, last_start: ColumnLike, now: Column) -> Column:
    """Lower bound sent to a change manifest.

    ``Nd`` counts back from now, other configured text gives no bound of its
    own (null) and a missing argument continues from the last start.
    """
    value = as_col(since_arg)
    return (
        F.when(value.isNull(), epoch_millis(overlap_start(default_start(last_start, now))))
        .when(relative_days(value).isNotNull(), epoch_millis(days_before(now, relative_days(value))))
    )
