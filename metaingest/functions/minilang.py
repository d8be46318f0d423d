"""Column expressions for the small text formats used in configuration rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col


def comma_items(text: ColumnLike) -> Column:
    """Items of a comma separated list, in order, blanks kept."""
    return F.split(as_col(text), ",")


def comma_keys(text: ColumnLike) -> Column:
    """Distinct, trimmed, non-blank items of a comma separated list."""
    trimmed = F.transform(comma_items(text), lambda item: F.trim(item))
    return F.array_distinct(F.filter(trimmed, lambda item: item != ""))


def kv_map(text: ColumnLike) -> Column:
    """Map from a ``k=v,k=v`` list.

    An item counts only if it splits on ``=`` into exactly two parts, so
    ``a=b=c`` and ``a`` are dropped. A repeated key keeps its first position
    and takes its last value. Null text gives an empty map.
    """
    parts = F.transform(comma_items(F.coalesce(as_col(text), F.lit(""))), lambda item: F.split(item, "="))
    pairs = F.filter(parts, lambda pair: F.size(pair) == 2)
    keys = F.array_distinct(F.transform(pairs, lambda pair: pair[0]))
    values = F.transform(keys, lambda key: F.element_at(F.filter(pairs, lambda pair: pair[0] == key), -1)[1])
    return F.map_from_arrays(keys, values)


def is_yes(flag: ColumnLike) -> Column:
    """True only for the flag character ``Y``."""
    return F.coalesce(as_col(flag) == "Y", F.lit(False))


def is_true_text(text: ColumnLike) -> Column:
    """Case-insensitive test for the text ``true``; null is false."""
    return F.coalesce(F.lower(as_col(text)) == "true", F.lit(False))


def content_type(text: ColumnLike) -> Column:
    """``JSON`` in any case gives JSON, everything else XML."""
    return F.when(F.upper(as_col(text)) == "JSON", "JSON").otherwise("XML")


def is_blank(text: ColumnLike) -> Column:
    """Null, empty or whitespace only."""
    return F.coalesce(F.trim(as_col(text)) == "", F.lit(True))


def is_table_key_list(text: ColumnLike) -> Column:
    """A key list holding an underscore names a table, else it lists keys."""
    return F.contains(as_col(text), F.lit("_"))
