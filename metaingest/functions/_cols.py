"""Shared helpers for column arguments and safe names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quoted(name: str) -> str:
    """Column name quoted for use in ``F.col``."""
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    return F.col(quoted(name))


def field(parent: str, name: str) -> Column:
    return F.col(f"{quoted(parent)}.{quoted(name)}")
