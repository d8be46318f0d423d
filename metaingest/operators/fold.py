"""Last writer wins per key, before anything meets the target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._cols import field, named
from ..functions.typed import to_column_type
from ..specs import TargetSpec
from .extract import ATTRS, any_of, bucket_present


def last_writer_wins(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: str | Column, absent: str = "keep"
) -> DataFrame:
    """One row per key with the latest values by ``order``.

    ``absent='keep'``: per column, the latest value that is not null.
    ``absent='null'``: the latest row as a whole.
    The aggregation combines before the shuffle, so a hot key costs each task
    one row.
    """
    order = F.col(order) if isinstance(order, str) else order
    if absent == "null":
        latest = F.max_by(F.struct(*[named(v) for v in values]), order)
        grouped = df.groupBy(*map(named, keys)).agg(latest.alias("_latest"))
        return grouped.select(*map(named, keys), *[field("_latest", v).alias(v) for v in values])
    if absent != "keep":
        raise ValueError("absent is 'keep' or 'null'")
    aggs = [F.max_by(named(v), F.when(named(v).isNotNull(), order)).alias(v) for v in values]
    return df.groupBy(*map(named, keys)).agg(*aggs)


def incoming_rows(parsed: DataFrame, target: TargetSpec, order: str = "id", absent: str = "keep") -> DataFrame:
    """Records as one typed row per key of the target.

    Columns: keys, values, and ``present`` (struct of booleans: which values
    the records supplied). Texts are folded before empties become null, so an
    empty value still overwrites and an absent one does not.
    """
    feeds = {b.name: bucket_present(b) for b in target.buckets}
    applies = any_of(list(feeds.values()))
    keys = [to_column_type(field(ATTRS, c.name), c.spark_type, c.length).alias(c.name) for c in target.keys]

    def value(name: str) -> Column:
        sources = [feeds[b.name] for b in target.buckets if name in b.values]
        text = field(ATTRS, name)
        return text if len(sources) == len(feeds) else F.when(any_of(sources), text)

    values = [value(c.name).alias(c.name) for c in target.values]
    usable = parsed.where(F.col("reason").isNull() & applies)
    rows = usable.select(*keys, *values, F.col(order).alias("_order"))
    folded = last_writer_wins(rows, target.key_names, target.value_names, "_order", absent)
    supplied = [
        (F.lit(True) if absent == "null" else named(c.name).isNotNull()).alias(c.name) for c in target.values
    ]
    return folded.select(
        *map(named, target.key_names),
        *[to_column_type(named(c.name), c.spark_type, c.length).alias(c.name) for c in target.values],
        F.struct(*supplied).alias("present"),
    )
