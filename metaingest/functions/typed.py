"""Column types of target tables: mapping, casting and typed equality."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import ColumnLike, as_col

DECIMAL_TYPE = "decimal(38,10)"
MOST_DIGITS = 38
_SIZED = re.compile(r"(\w+)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)")
_NUMBER = r"^\s*[+-]?(\d*)\.?(\d*)(?:[eE]([+-]?\d+))?\s*$"

# Configured type name -> (database type, Spark type).
CONFIG_TYPES = {
    "Varchar2": ("VarChar", "string"),
    "Clob": ("Text", "string"),
    "Int32": ("Int", "int"),
    "Int64": ("BigInt", "bigint"),
    "Double": ("Decimal", DECIMAL_TYPE),
    "BigInt": ("BigInt", "bigint"),
    "Decimal": ("Decimal", DECIMAL_TYPE),
    "Date": ("Date", "date"),
    "DateTime": ("DateTime", "timestamp_ntz"),
}
DEFAULT_TYPE = ("VarChar", "string")

# Comparison class of each database type; any other is text.
COMPARISON_CLASSES = {
    "date": ("Date", "DateTime", "DateTime2", "SmallDateTime", "Time"),
    "integer": ("BigInt", "Bit", "Int", "SmallInt", "TinyInt"),
    "double": ("Decimal", "Float", "Money", "Real", "SmallMoney"),
}

_CLASS_CASTS = {"date": "timestamp_ntz", "integer": "bigint", "double": "double"}


def map_type(config_name: str | None, decimal_type: str = DECIMAL_TYPE) -> tuple[str, str]:
    """(database type, Spark type) for a configured type name.

    Decimal types may name their digits and decimals, as in ``Decimal(12,2)``;
    without them they have the ``decimal_type``.
    """
    sized = _SIZED.fullmatch((config_name or "").strip())
    db_type, spark_type = CONFIG_TYPES.get(sized[1] if sized else config_name or "", DEFAULT_TYPE)
    if spark_type != DECIMAL_TYPE:
        return db_type, spark_type
    if sized is None:
        return db_type, decimal_type
    digits, decimals = int(sized[2]), int(sized[3] or 0)
    if not 1 <= digits <= MOST_DIGITS or decimals > digits:
        raise ValueError(f"no such decimal type: {config_name}")
    return db_type, f"decimal({digits},{decimals})"


def comparison_class(db_type: str) -> str:
    for name, members in COMPARISON_CLASSES.items():
        if db_type in members:
            return name
    return "string"


def empty_to_null(value: ColumnLike) -> Column:
    return F.nullif(as_col(value), F.lit(""))


def fits_type(value: ColumnLike, spark_type: str) -> Column:
    """False only for non-empty text that does not cast to the type."""
    text = as_col(value)
    if spark_type == "string":
        return F.lit(True)
    return empty_to_null(text).isNull() | text.try_cast(spark_type).isNotNull()


def keeps_value(value: ColumnLike, spark_type: str) -> Column:
    """False only for text that casts to the type as another value: a number with
    more decimals than a decimal type has, or a time beyond its microseconds.

    Decimals are counted in the text, so no digit is lost on the way to the answer.
    """
    text = as_col(value)
    if spark_type.startswith("decimal"):
        scale = int(spark_type.rstrip(")").split(",")[1])
        whole, part = (F.regexp_extract(text, _NUMBER, group) for group in (1, 2))
        exponent = F.coalesce(F.regexp_extract(text, _NUMBER, 3).try_cast("int"), F.lit(0))
        digits = F.rtrim(F.concat(whole, part), F.lit("0"))
        zeros = F.length(whole) + F.length(part) - F.length(digits)
        exact = (F.ltrim(digits, F.lit("0")) == "") | (F.length(part) - exponent - zeros <= scale)
        # Most texts have no exponent and few decimals, which one look tells.
        return F.when(text.rlike(rf"[eE]|\.\d{{{scale}}}\d*[1-9]"), exact).otherwise(F.lit(True))
    if spark_type.startswith("timestamp"):
        return F.coalesce(~text.rlike(r"\.\d{6}\d*[1-9]"), F.lit(True))
    return F.lit(True)


def is_truncated(value: ColumnLike, length: int) -> Column:
    """True when the text is longer than a positive column length."""
    return F.coalesce(F.length(as_col(value)) > length, F.lit(False)) if length > 0 else F.lit(False)


def to_column_type(value: ColumnLike, spark_type: str, length: int = -1) -> Column:
    """Text as stored: empty as null, cut to a positive length, cast."""
    text = empty_to_null(value)
    if spark_type == "string":
        return F.left(text, F.lit(length)) if length > 0 else text
    return text.try_cast(spark_type)


def numeric_key(key: ColumnLike) -> Column:
    return as_col(key).try_cast("bigint")


def text_equal(old: ColumnLike, new: ColumnLike, class_name: str) -> Column:
    """Equality of two text values under a comparison class.

    Two empties are equal and an empty differs from a value. Text that does
    not cast on either side is compared as text.
    """
    left, right = empty_to_null(old), empty_to_null(new)
    cast_type = _CLASS_CASTS.get(class_name)
    if cast_type is None:
        return left.eqNullSafe(right)
    left_typed, right_typed = left.try_cast(cast_type), right.try_cast(cast_type)
    castable = left_typed.isNotNull() & right_typed.isNotNull()
    return F.when(castable, left_typed == right_typed).otherwise(left.eqNullSafe(right))
