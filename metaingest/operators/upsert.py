"""Typed change detection and keyed upsert as one join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._cols import field, named
from ..functions.typed import text_equal

INSERTED, UPDATED, UNCHANGED, UNTOUCHED = "inserted", "updated", "unchanged", "untouched"
ACTION = "action"
ADDED_AT, UPDATED_AT = "add_dtime", "upd_dtime"


def same_record(pairs: Sequence[tuple[Column, Column, str]]) -> Column:
    """Typed equality of (old, new, class) texts; a null new text is not compared."""
    tests = [new.isNull() | text_equal(old, new, kind) for old, new, kind in pairs]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def rows_by_key(target: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in ``keys_df``."""
    return target.join(keys_df.select(*map(named, keys)), list(keys), "left_semi")


def row_count(target: DataFrame, name: str = "row_count") -> DataFrame:
    return target.agg(F.count("*").alias(name))


def upsert_rows(
    target: DataFrame | None, incoming: DataFrame, keys: Sequence[str], values: Sequence[str], now: Column
) -> DataFrame:
    """The whole new target with an ``action`` per row.

    ``incoming`` holds one typed row per non-null key and a ``present`` struct.
    A value that is not present keeps what the target has. ``upd_dtime`` moves
    only when a present value differs. Other target columns are kept.
    """
    if target is None:
        return incoming.select(
            *map(named, keys),
            *map(named, values),
            now.alias(ADDED_AT),
            now.alias(UPDATED_AT),
            F.lit(INSERTED).alias(ACTION),
        )
    others = [c for c in target.columns if c not in {*keys, *values, ADDED_AT, UPDATED_AT}]
    old = target.withColumn("_old", F.lit(True)).alias("o")
    for value in (v for v in values if v not in target.columns):
        old = old.withColumn(value, F.lit(None).cast(incoming.schema[value].dataType))
    old = old.alias("o")
    new = incoming.withColumn("_new", F.lit(True)).alias("n")
    matched = reduce(lambda a, b: a & b, [field("o", k) == field("n", k) for k in keys])
    joined = old.join(new, matched, "full_outer")

    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()

    def supplied(value: str) -> Column:
        return F.coalesce(F.col("n.present").getField(value), F.lit(False))

    differs = reduce(
        lambda a, b: a | b,
        [supplied(v) & ~field("o", v).eqNullSafe(field("n", v)) for v in values],
        F.lit(False),
    )
    action = (
        F.when(~is_old, INSERTED).when(~is_new, UNTOUCHED).when(differs, UPDATED).otherwise(UNCHANGED)
    )
    added_at = F.when(is_old, F.col(f"o.{ADDED_AT}")).otherwise(now)
    updated_at = F.when(is_old & ~(is_new & differs), F.col(f"o.{UPDATED_AT}")).otherwise(now)
    return joined.select(
        *[F.coalesce(field("o", k), field("n", k)).alias(k) for k in keys],
        *[F.when(supplied(v), field("n", v)).otherwise(field("o", v)).alias(v) for v in values],
        *[field("o", c).alias(c) for c in others],
        added_at.alias(ADDED_AT),
        updated_at.alias(UPDATED_AT),
        action.alias(ACTION),
    )


def action_counts(upserted: DataFrame) -> DataFrame:
    """Rows per action, one row."""
    return upserted.agg(
        *[F.count_if(F.col(ACTION) == a).alias(a) for a in (INSERTED, UPDATED, UNCHANGED, UNTOUCHED)]
    )
