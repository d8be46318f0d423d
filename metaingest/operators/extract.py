"""From archived payloads to flat records, and to the reasons why not."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._cols import as_col, field
from ..functions.documents import DOCUMENT, WELL_FORMED, Slot, extract_slots
from ..functions.paths import path_kind
from ..functions.typed import empty_to_null, fits_type, is_truncated, keeps_value
from ..specs import ApiSpec, BucketSpec

ERROR_PAYLOAD = "error_payload"
NOT_A_DOCUMENT = "not_a_document"
TOO_FEW_ATTRIBUTES = "too_few_attributes"
BLANK_TARGET_KEY = "blank_target_key"
BAD_VALUE = "bad_value"
VALUE_ALTERED = "value_altered"

ATTRS = "attrs"


def is_error_payload(data) -> Column:
    """The payload reports an error instead of data."""
    text = as_col(data)
    return F.coalesce(F.contains(text, F.lit("<errors>")) | F.contains(text, F.lit("<error>")), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def bucket_present(bucket: BucketSpec, attrs: str = ATTRS) -> Column:
    """Some non-key attribute of the bucket is non-empty."""
    return any_of([F.coalesce(field(attrs, name) != "", F.lit(False)) for name in bucket.values])


def present_buckets(buckets: list[BucketSpec], attrs: str = ATTRS) -> Column:
    """Names of the buckets a record applies to."""
    return F.array_compact(F.array(*[F.when(bucket_present(b, attrs), b.name) for b in buckets]))


def fan_out(parsed: DataFrame, buckets: list[BucketSpec]) -> DataFrame:
    """One row per record and bucket it applies to, without a join."""
    return parsed.withColumn("bucket", F.explode(present_buckets(buckets)))


def parse_payloads(archive: DataFrame, api: ApiSpec, data: str = "data") -> DataFrame:
    """Replace the payload by ``attrs`` (struct of texts) and ``reason``.

    In ``attrs`` null means the element is absent and ``''`` that it is empty.
    Each payload is parsed once for all its paths. ``reason`` is null for a
    record that has more than one attribute.
    """
    slots = api.slots()
    units: list[Slot] = []
    readers: list[list[tuple[str, str]]] = []
    for slot in slots:
        kinds = {path_kind(path) for path, _ in slot.candidates}
        if kinds <= {"tree"}:
            readers.append([("tree", str(len(units)))])
            units.append(slot)
            continue
        reader = []
        for path, is_body in reversed(slot.candidates):
            if path_kind(path) == "tree":
                reader.append(("tree", str(len(units))))
                units.append(Slot(slot.name, ((path, is_body),)))
            else:
                reader.append(("xpath", path))
        readers.append(reader)
    needs_document = any(kind == "xpath" for reader in readers for kind, _ in reader)

    error = is_error_payload(data)
    parsed = archive.withColumn(
        "_v", extract_slots(F.when(~error, as_col(data)), units, api.content_type, needs_document)
    ).withColumn("_error", error)

    def value(kind: str, ref: str) -> Column:
        if kind == "tree":
            return F.col(f"_v.s{ref}")
        document = F.col(f"_v.{DOCUMENT}")
        return F.when(F.xpath_boolean(document, F.lit(ref)), F.xpath_string(document, F.lit(ref)))

    values = [F.coalesce(*[value(*r) for r in reader]).alias(slot.name) for slot, reader in zip(slots, readers)]
    attrs = F.struct(*values) if values else F.struct(F.lit(None).cast("string").alias("none"))
    count = reduce(lambda a, b: a + b, [F.when(field(ATTRS, s.name).isNotNull(), 1).otherwise(0) for s in slots], F.lit(0))
    keep = [c for c in archive.columns if c != data]
    reason = (
        F.when(F.col("_error"), ERROR_PAYLOAD)
        .when(~F.col(f"_v.{WELL_FORMED}"), NOT_A_DOCUMENT)
        .when(count <= 1, TOO_FEW_ATTRIBUTES)
    )
    return parsed.withColumn(ATTRS, attrs).select(*keep, ATTRS, reason.alias("reason"))


def check_values(parsed: DataFrame, api: ApiSpec) -> DataFrame:
    """Also give a reason to records whose values do not fit their columns.

    Only buckets the record applies to are checked. ``detail`` names the
    attributes; ``truncated`` names texts longer than their column. A value that its
    column would store as another one, such as a number with more decimals, is a
    reason too: nothing is rounded in silence.
    """
    bad, blank, cut, altered = [], [], [], []
    for bucket in api.buckets:
        if not (bucket.keys and bucket.values):
            continue
        present = bucket_present(bucket)
        for column in bucket.columns:
            text = field(ATTRS, column.name)
            bad.append(F.when(present & ~fits_type(text, column.spark_type), column.name))
            altered.append(F.when(present & ~keeps_value(text, column.spark_type), column.name))
            if column.is_key:
                blank.append(F.when(present & empty_to_null(text).isNull(), column.name))
            if column.spark_type == "string" and column.length > 0:
                cut.append(F.when(present & is_truncated(text, column.length), column.name))

    def names(items: list[Column]) -> Column:
        return F.array_distinct(F.array_compact(F.array(*items))) if items else F.array().cast("array<string>")

    checked = parsed.withColumns({"_bad": names(bad), "_blank": names(blank), "_altered": names(altered)})
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.size("_blank") > 0, BLANK_TARGET_KEY)
        .when(F.size("_bad") > 0, BAD_VALUE)
        .when(F.size("_altered") > 0, VALUE_ALTERED)
    )
    found = {BLANK_TARGET_KEY: "_blank", BAD_VALUE: "_bad", VALUE_ALTERED: "_altered"}
    detail = F.coalesce(*[F.when(F.col("reason") == r, F.array_join(c, ",")) for r, c in found.items()])
    return (
        checked.withColumn("truncated", names(cut))
        .withColumn("reason", reason)
        .withColumn("detail", detail)
        .drop(*found.values())
    )
