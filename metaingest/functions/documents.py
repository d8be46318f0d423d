"""Arrow functions over XML and JSON bodies: one parse per body and stage.

The functions are marked non-deterministic on purpose: it stops the optimizer
from copying the parse into a pushed-down filter and running it twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _trees as trees
from ._cols import ColumnLike, as_col
from .paths import is_tree_filter


@dataclass(frozen=True)
class Slot:
    """One output attribute and its candidate (path, is_body) pairs, last match wins."""

    name: str
    candidates: tuple[tuple[str, bool], ...]


WELL_FORMED = "well_formed"
DOCUMENT = "document"
#: Characters of records that one chunk holds, unless one record is longer.
CHUNK_CHARS = 1 << 20


def extract_slots(body: ColumnLike, slots: Sequence[Slot], content_type: str, keep_document: bool = False) -> Column:
    """Struct of the slot texts: null = element absent, ``''`` = present and empty.

    ``slot fields`` are named ``s0, s1, ...``; ``well_formed`` is false for a
    body that is no document; ``document`` is its canonical XML if asked for.
    """
    is_json = content_type == "JSON"
    candidates = [list(reversed(slot.candidates)) for slot in slots]
    names = [f"s{i}" for i in range(len(slots))]
    fields = [T.StructField(name, T.StringType()) for name in names]
    fields.append(T.StructField(WELL_FORMED, T.BooleanType()))
    if keep_document:
        fields.append(T.StructField(DOCUMENT, T.StringType()))

    def extract(bodies: pa.Array) -> pa.Array:
        plans = trees.compile_slots(candidates)
        columns: list[list] = [[] for _ in fields]
        for row in trees.slot_rows(bodies.to_pylist(), is_json, plans, len(names), keep_document):
            for values, value in zip(columns, row):
                values.append(value)
        types = [pa.string()] * len(names) + [pa.bool_()] + [pa.string()] * keep_document
        arrays = [pa.array(values, type=kind) for values, kind in zip(columns, types)]
        return pa.StructArray.from_arrays(arrays, names=[f.name for f in fields])

    udf = F.arrow_udf(extract, T.StructType(fields)).asNondeterministic()
    return udf(as_col(body))


def page_links(body: ColumnLike, indicator_tag: str, anchor_tag: str, content_type: str) -> Column:
    """Struct (well_formed, indicator, anchor) of a page's root children."""
    is_json = content_type == "JSON"
    schema = T.StructType(
        [
            T.StructField(WELL_FORMED, T.BooleanType()),
            T.StructField("indicator", T.StringType()),
            T.StructField("anchor", T.StringType()),
        ]
    )

    def links(bodies: pa.Array) -> pa.Array:
        rows = []
        for body in bodies:
            texts = trees.root_texts(body, [indicator_tag, anchor_tag], is_json)
            rows.append((texts is not None, *(texts or (None, None))))
        good, indicator, anchor = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(good, pa.bool_()), pa.array(indicator, pa.string()), pa.array(anchor, pa.string())],
            names=[WELL_FORMED, "indicator", "anchor"],
        )

    return F.arrow_udf(links, schema).asNondeterministic()(as_col(body))


def record_chunks(
    pages: DataFrame,
    body: str,
    record_tag: str,
    key_tag: str,
    content_type: str,
    value_paths: Sequence[str] = (),
    whole_texts: bool = False,
    filter_path: str | None = None,
) -> DataFrame:
    """The records of each page, root children with the record tag, in chunks.

    A row has a page's other columns, ``_first``, the number of its first record,
    and ``_records``, an array of about ``CHUNK_CHARS`` at most or of one longer
    record. Each record is (key, body, values, marked, passes): the key child's text or
    null, the record's own XML, per value path the distinct texts found in it,
    with ``whole_texts`` its XML with every element's whole text as an attribute, and
    whether ``filter_path`` selects anything in it. That is null where the tree doesn't
    tell: for other paths than ``is_tree_filter`` names, and records with namespaces.
    A page that is no document gives one row with a null array, a page without
    records none; a blank record or key tag selects nothing.

    An XML page is read twice in pieces, first to know that it is a document: a
    task holds the page's text and one chunk, never its tree.
    """
    is_json = content_type == "JSON"
    paths = list(value_paths)
    selects = bool(record_tag) and bool(key_tag)
    text_type = T.StringType()
    record_type = T.StructType(
        [
            T.StructField("key", text_type),
            T.StructField("body", text_type),
            T.StructField("values", T.ArrayType(T.ArrayType(text_type))),
            T.StructField("marked", text_type),
            T.StructField("passes", T.BooleanType()),
        ]
    )
    others = [f for f in pages.schema.fields if f.name != body]
    schema = T.StructType([*others, T.StructField("_first", T.IntegerType()), T.StructField("_records", T.ArrayType(record_type))])
    item_types = [pa.string(), pa.string(), pa.list_(pa.list_(pa.string())), pa.string(), pa.bool_()]
    told = filter_path if filter_path and is_tree_filter(filter_path) else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finders = [trees.compile_path(path) for path in paths]
        selected = trees.compile_path(told) if told else None
        for batch in batches:
            kept = batch.select([f.name for f in others])
            rows, firsts, missing, offsets = [], [], [], [0]
            items: list[list] = [[] for _ in item_types]
            held = 0

            def chunk() -> pa.RecordBatch:
                arrays = [pa.array(values, kind) for values, kind in zip(items, item_types)]
                structs = pa.StructArray.from_arrays(arrays, names=record_type.names)
                records = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, mask=pa.array(missing, pa.bool_()))
                columns = kept.take(pa.array(rows, pa.int64())).columns
                return pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.int32()), records], names=schema.names)

            def close_row(row: int, first: int, bad: bool = False) -> None:
                rows.append(row)
                firsts.append(first)
                missing.append(bad)
                offsets.append(len(items[0]))

            pages_records = trees.records_of_pages(batch.column(body), record_tag if selects else None, is_json)
            for row, records in enumerate(pages_records):
                if records is None:
                    close_row(row, 0, True)
                    continue
                first = number = 0
                for record in records:
                    text = trees.xml_of(record)
                    marked = trees.marked_xml(record) if whole_texts else None
                    key, holder = trees.child_text(record, key_tag), _holder(record)
                    found = [trees.distinct_texts(holder, finder) for finder in finders]
                    passes = bool(selected(holder)) if selected and "xmlns" not in text else None
                    for column, value in zip(items, (key, text, found, marked, passes)):
                        column.append(value)
                    number += 1
                    held += len(text) + len(marked or "")
                    if held >= CHUNK_CHARS:
                        close_row(row, first)
                        yield chunk()
                        first, held = number, 0
                        rows, firsts, missing, offsets, items = [], [], [], [0], [[] for _ in item_types]
                if number > first:
                    close_row(row, first)
            if rows:
                yield chunk()

    return pages.mapInArrow(cut, schema)


def _holder(record: trees.ET.Element) -> trees.ET.Element:
    """The record as a document of its own."""
    holder = trees.ET.Element("")
    holder.append(record)
    return holder


def register_functions(spark: SparkSession) -> None:
    """Make the extraction functions callable from SQL.

    ``xml_text_at(body, path)`` and ``xml_body_at(body, path)`` return the
    first match; ``LATERAL xml_records(body, record_tag, key_tag)`` returns
    (position, key, body) rows, and one row of nulls for a body that is no
    document.
    """

    def matcher(render):
        def at(bodies: pa.Array, paths: pa.Array) -> pa.Array:
            finders: dict[str, trees.Finder] = {}
            out = []
            for text, path in zip(bodies.to_pylist(), paths.to_pylist()):
                document = trees.parse_document(text, False)
                hit = None
                if document is not None and path is not None:
                    if path not in finders:
                        finders[path] = trees.compile_path(path)
                    hit = trees.first_match(document, finders[path])
                out.append(None if hit is None else render(hit))
            return pa.array(out, pa.string())

        return F.arrow_udf(at, T.StringType())

    class XmlRecords:
        def eval(self, body: str, record_tag: str, key_tag: str):
            document = trees.parse_document(body, False)
            if document is None:
                yield None, None, None
            elif record_tag and key_tag:
                for position, record in enumerate(document[0].findall(record_tag)):
                    yield position, trees.child_text(record, key_tag), trees.xml_of(record)

    spark.udf.register("xml_text_at", matcher(trees.text_of))
    spark.udf.register("xml_body_at", matcher(trees.xml_of))
    spark.udtf.register(
        "xml_records", F.udtf(XmlRecords, returnType="position int, key string, body string", useArrow=True)
    )
