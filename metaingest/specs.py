"""Configuration as plain values: what one process reads, extracts and writes."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from .functions.documents import Slot
from .functions.paths import path_kind
from .functions.typed import comparison_class, map_type


class SpecError(ValueError):
    """Configuration that cannot be run."""


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a target table and where its value comes from."""

    name: str
    path: str
    config_type: str = "Varchar2"
    length: int = -1
    is_key: bool = False
    is_body: bool = False

    @property
    def db_type(self) -> str:
        return map_type(self.config_type)[0]

    @property
    def spark_type(self) -> str:
        return map_type(self.config_type)[1]

    @property
    def compare_as(self) -> str:
        return comparison_class(self.db_type)


@dataclass(frozen=True)
class BucketSpec:
    """A slice of a payload that feeds columns of one table."""

    name: str
    table: str = ""
    columns: tuple[ColumnSpec, ...] = ()

    @property
    def keys(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if c.is_key)

    @property
    def values(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns if not c.is_key)


@dataclass(frozen=True)
class TargetSpec:
    """All buckets that write one table with the same key columns."""

    table: str
    keys: tuple[ColumnSpec, ...]
    values: tuple[ColumnSpec, ...]
    buckets: tuple[BucketSpec, ...]

    @property
    def key_names(self) -> list[str]:
        return [c.name for c in self.keys]

    @property
    def value_names(self) -> list[str]:
        return [c.name for c in self.values]


@dataclass(frozen=True)
class ApiSpec:
    """One endpoint: a change manifest or a payload service."""

    base_url: str = ""
    since_arg: str = ""
    anchor_indicator: str = ""
    anchor_element: str = ""
    anchor_args: dict[str, str] = field(default_factory=dict)
    request_args: dict[str, str] = field(default_factory=dict)
    header_args: dict[str, str] = field(default_factory=dict)
    response_filter: str = ""
    record_tag: str = ""
    key_tag: str = ""
    key_list: str | None = None
    content_type: str = "XML"
    buckets: tuple[BucketSpec, ...] = ()

    def with_request_arg(self, name: str, value: str) -> ApiSpec:
        return replace(self, request_args={**self.request_args, name: value})

    def slots(self) -> list[Slot]:
        """Attributes of the flat record, in first-seen order.

        Buckets naming the same attribute share one slot; the last bucket
        whose element exists supplies the value.
        """
        found: dict[str, list[tuple[str, bool]]] = {}
        for bucket in self.buckets:
            for column in bucket.columns:
                found.setdefault(column.name, []).append((column.path, column.is_body))
        folded = {name.lower() for name in found}
        if len(folded) != len(found):
            raise SpecError(f"attribute names differ only in case: {sorted(found)}")
        return [Slot(name, tuple(dict.fromkeys(paths))) for name, paths in found.items()]

    def targets(self) -> list[TargetSpec]:
        """Buckets with columns, grouped by table and key columns."""
        grouped: dict[tuple[str, frozenset[str]], list[BucketSpec]] = {}
        for bucket in self.buckets:
            if bucket.values and bucket.keys:
                grouped.setdefault((bucket.table, frozenset(bucket.keys)), []).append(bucket)
        return [_target(table, buckets) for (table, _), buckets in grouped.items()]

    def problems(self) -> list[str]:
        """Buckets that can never be written, in words."""
        return [
            f"bucket {b.name} of table {b.table} has no key column" for b in self.buckets if b.columns and not b.keys
        ]


def _target(table: str, buckets: list[BucketSpec]) -> TargetSpec:
    keys: dict[str, ColumnSpec] = {}
    values: dict[str, ColumnSpec] = {}
    for bucket in buckets:
        for column in bucket.columns:
            known = (keys if column.is_key else values).setdefault(column.name, column)
            if known.config_type != column.config_type or known.length != column.length:
                raise SpecError(f"column {column.name} of table {table} is configured with two types")
    return TargetSpec(table, tuple(keys.values()), tuple(values.values()), tuple(buckets))


@dataclass(frozen=True)
class ProcessSpec:
    process_id: int
    name: str = ""
    change_api: ApiSpec | None = None
    data_api: ApiSpec | None = None

    def validate(self) -> list[str]:
        """Check everything that does not need Spark; returns xpath-kind paths."""
        if self.change_api is None or self.data_api is None:
            raise SpecError(f"process {self.process_id} needs a change (C) and a data (D) configuration")
        slots = self.data_api.slots()
        self.data_api.targets()
        for column in (c for bucket in self.data_api.buckets for c in bucket.columns):
            try:
                map_type(column.config_type)
            except ValueError as error:
                raise SpecError(f"column {column.name}: {error}") from error
        xpaths = [self.change_api.response_filter] if self.change_api.response_filter else []
        paths = [(path, body) for slot in slots for path, body in slot.candidates]
        paths += [(v, False) for v in self.data_api.request_args.values() if v.startswith("//")]
        for path, is_body in paths:
            if path_kind(path) == "xpath":
                if is_body:
                    raise SpecError(f"path of an XML body column must be an element path: {path}")
                xpaths.append(path)
        return xpaths
