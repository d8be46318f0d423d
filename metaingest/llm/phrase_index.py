"""Positional inverted index: exact phrases and proximity, for decontamination.

The index has one row for each segment, some whole documents of one task with
``SEGMENT_WORDS`` words: its terms in order, and for each term the sorted places
of its words in the segment. No shuffle is needed to build it, a common term is
spread over all segments, and a search runs on all segments at once.

A search goes through stated queries in blocks of ``BLOCK_QUERIES``, which the
driver reads one after the other; a block's matches are written before the next
one is read, and name queries by hash. Item ids meet them by a join. One pass
counts the postings of the block's terms over all segments; queries with a term
that occurs nowhere are done. The other pass takes each query's terms from the
rarest on: where a segment lacks one it is done there; else the places of each
term, moved back by the term's offset in the phrase, are intersected until none
is left or all terms are through. For proximity the places of all terms are
searched for stretches of ``within`` words that hold every term.

Terms are 64-bit hashes of lower-cased words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import words as w

SEGMENT_WORDS = 1 << 18
BLOCK_QUERIES = 200_000
WINDOW = 13


def build_index(docs: DataFrame, table: np.ndarray = w.ALPHANUMERIC) -> DataFrame:
    """Writes the index of all ``docs`` and returns it.

    ``doc_ids`` and ``text_hashes`` list a segment's documents, ``first`` the
    places where their words start, with the number of words at the end. Null
    and empty texts are documents without words.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    @w.releasing
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        ids, text_hashes, hashes, counts, held = [], [], [], [], 0
        for batch in batches:
            keys, marks = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for low, high, texts in w.text_slices(batch.column("text")):
                words = w.find_words(texts, table)
                ids += keys[low:high]
                text_hashes += marks[low:high]
                hashes.append(w.hash_spans(texts.data, words.starts, words.ends))
                counts.append(np.diff(words.first))
                held += len(words.starts)
                if held >= SEGMENT_WORDS:
                    yield _segment(number, pa.array(ids, batch.schema.field("doc_id").type), text_hashes, hashes, counts)
                    ids, text_hashes, hashes, counts, held = [], [], [], [], 0
                    number += 1
        if ids:
            yield _segment(number, pa.array(ids, batch.schema.field("doc_id").type), text_hashes, hashes, counts)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    schema = f"segment long, doc_ids array<{kind}>, text_hashes array<long>, first array<int>, terms binary, starts binary, places binary"
    return stage(rows.mapInArrow(build, schema), "phrase-index")


def _segment(number: int, ids: pa.Array, text_hashes: list, hashes: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    words = np.concatenate(hashes)
    places = np.argsort(words, kind="stable").astype(np.uint32)
    ordered = words[places]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, np.int64)
    first = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([text_hashes], pa.list_(pa.int64())),
            pa.array([first.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([ordered[starts].tobytes()], pa.binary()),
            pa.array([np.append(starts, len(ordered)).astype(np.uint32).tobytes()], pa.binary()),
            pa.array([places.tobytes()], pa.binary()),
        ],
        ["segment", "doc_ids", "text_hashes", "first", "terms", "starts", "places"],
    )


class Segment:
    """Postings of one segment."""

    def __init__(self, first: list[int], terms: bytes, starts: bytes, places: bytes):
        self.first = np.asarray(first, np.int64)
        self.terms = np.frombuffer(terms, np.uint64)
        self._starts = np.frombuffer(starts, np.uint32)
        self._places = np.frombuffer(places, np.uint32)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The number of each term here, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def counts(self, numbers: np.ndarray) -> np.ndarray:
        return np.where(numbers < 0, 0, self._starts[numbers + 1].astype(np.int64) - self._starts[numbers])

    def places(self, number: int) -> np.ndarray:
        return self._places[self._starts[number] : self._starts[number + 1]].astype(np.int64)

    def document(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1

    def phrase(self, numbers: list[int], offsets: list[int], length: int) -> np.ndarray:
        """Places where the phrase starts; terms come from the rarest on."""
        found = self.places(numbers[0]) - offsets[0]
        found = found[found >= 0]
        for number, offset in zip(numbers[1:], offsets[1:]):
            if not len(found):
                break
            places = self.places(number)
            at = np.minimum(np.searchsorted(places, found + offset), len(places) - 1)
            found = found[places[at] == found + offset]
        return found[self.document(found) == self.document(found + length - 1)]

    def near(self, numbers: list[int], within: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the shortest stretches with every term."""
        lists = [self.places(number) for number in dict.fromkeys(numbers)]
        starts = np.unique(np.concatenate(lists))
        reach = starts.copy()
        for places in lists:
            at = np.searchsorted(places, starts)
            following = np.append(places, np.iinfo(np.int64).max)[at]
            reach = np.maximum(reach, following)
        fits = (reach < self.first[-1]) & (reach - starts < within)
        starts, reach = starts[fits], reach[fits]
        same = self.document(starts) == self.document(reach)
        return starts[same], reach[same] + 1


class Block(NamedTuple):
    """Distinct queries: ``terms`` and ``offsets`` have a row for each, its terms
    from the rarest on, ``length`` how many of them count, and ``queries`` its hash."""

    terms: np.ndarray
    offsets: np.ndarray
    length: np.ndarray
    queries: np.ndarray


def windows_of(items: DataFrame, window: int = WINDOW, table: np.ndarray = w.ALPHANUMERIC) -> DataFrame:
    """``item_id`` and ``terms`` of every run of ``window`` words; an item with
    fewer is one window, one without words has none."""
    kind = items.schema["item_id"].dataType.simpleString()

    @w.releasing
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, texts in w.text_slices(batch.column("text")):
                words = w.find_words(texts, table)
                hashes = w.hash_spans(texts.data, words.starts, words.ends)
                rows, terms = [], []
                for i, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
                    for start in range(a, max(b - window, a) + 1) if b > a else ():
                        rows.append(low + i)
                        terms.append(hashes[start : min(start + window, b)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item_id").take(pa.array(rows, pa.int64())), pa.array(terms, pa.binary())], ["item_id", "terms"]
                )

    return items.select("item_id", "text").mapInArrow(cut, f"item_id {kind}, terms binary")


def _blocks(owners: DataFrame, size: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The distinct queries in blocks of bounded size, each with its hashes."""
    rows = stage(owners.select("query", "terms").distinct(), "phrase-queries").toLocalIterator(prefetchPartitions=False)
    while block := list(islice(rows, size)):
        yield [np.frombuffer(row.terms, np.uint64) for row in block], np.array([row["query"] for row in block], np.int64)


def _ordered(index: DataFrame, queries: list[np.ndarray], hashes: np.ndarray) -> Block:
    """Terms from the rarest on, without queries that have a term of no posting."""
    distinct = np.unique(np.concatenate(queries))

    @w.releasing
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(distinct), np.int64)
        for segment, _, _ in _segments(batches):
            total += segment.counts(segment.find(distinct))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["term", "postings"])

    rows = index.select("segment", "first", "terms", "starts", "places").mapInArrow(count, "term long, postings long")
    totals = rows.groupBy("term").agg(F.sum("postings").alias("postings")).toArrow()
    postings = np.zeros(len(distinct), np.int64)
    postings[totals["term"].to_numpy()] = totals["postings"].to_numpy()

    width = max(map(len, queries))
    terms, offsets, lengths, kept = [], [], [], []
    for query, of in zip(queries, hashes.tolist()):
        rarity = postings[np.searchsorted(distinct, query)]
        if rarity.all():
            order = np.argsort(rarity, kind="stable")
            fill = np.full(width - len(query), order[0])
            order = np.concatenate((order, fill))
            terms.append(query[order])
            offsets.append(order)
            lengths.append(len(query))
            kept.append(of)
    shape = (len(kept), width)
    return Block(np.array(terms, np.uint64).reshape(shape), np.array(offsets, np.int64).reshape(shape), np.array(lengths, np.int64), np.array(kept, np.int64))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Segment, int, int]]:
    for batch in batches:
        first, terms, starts, places = (batch.column(c) for c in ("first", "terms", "starts", "places"))
        for row in range(batch.num_rows):
            segment = Segment(first[row].values.to_numpy(), terms[row].as_py(), starts[row].as_py(), places[row].as_py())
            yield segment, batch.column("segment")[row].as_py(), row


def _search(block: Block, within: int | None):
    @w.releasing
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, number, _ in _segments(batches):
            alive = np.arange(len(block.terms))
            for rank in range(block.terms.shape[1]):
                alive = alive[segment.find(block.terms[alive, rank]) >= 0]
            matches: dict[int, tuple[list, list, dict]] = {}
            for query in alive.tolist():
                length = int(block.length[query])
                numbers = segment.find(block.terms[query, :length]).tolist()
                if within is None:
                    starts = segment.phrase(numbers, block.offsets[query, :length].tolist(), length)
                    ends = starts + length
                else:
                    starts, ends = segment.near(numbers, within)
                documents = segment.document(starts)
                for place, start, end in zip(documents.tolist(), starts.tolist(), ends.tolist()):
                    held = matches.setdefault(place, ([], [], {}))
                    held[0].append(start - int(segment.first[place]))
                    held[1].append(end - int(segment.first[place]))
                    held[2][int(block.queries[query])] = True
            rows = sorted(matches)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * len(rows), pa.int64()),
                    pa.array(rows, pa.int32()),
                    pa.array([_merged(*matches[r][:2]) for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([list(matches[r][2]) for r in rows], pa.list_(pa.int64())),
                ],
                ["segment", "place", "spans", "queries"],
            )

    return search


def _merged(starts: list[int], ends: list[int]) -> list[dict]:
    """Spans without overlaps, in order."""
    out: list[dict] = []
    for start, end in sorted(zip(starts, ends)):
        if out and start <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], end)
        else:
            out.append({"start": start, "end": end})
    return out


def search(index: DataFrame, queries: DataFrame, within: int | None = None, block: int = BLOCK_QUERIES) -> DataFrame:
    """Every document of the index with its matches.

    ``queries`` has ``item_id`` and ``terms``, as from ``windows_of``. Without
    ``within`` a query matches where its terms stand as a phrase; with it, where
    as many consecutive words hold them all in any order. The columns are
    ``doc_id``, ``text_hash``, ``n_words``, ``spans`` (matched words, merged) and
    ``items`` (distinct ids of matching queries; a null id matches but is not
    listed). Documents without a match have empty lists.
    """
    item_kind = queries.schema["item_id"].dataType.simpleString()
    owners = stage(queries.select(F.xxhash64("terms").alias("query"), "terms", "item_id").distinct(), "phrase-owners")
    hits = None
    for terms, hashes in _blocks(owners, block):
        rows = index.select("segment", "first", "terms", "starts", "places").mapInArrow(
            _search(_ordered(index, terms, hashes), within),
            "segment long, place int, spans array<struct<start: bigint, end: bigint>>, queries array<bigint>",
        )
        rows = stage(rows, "phrase-hits")
        hits = rows if hits is None else hits.unionByName(rows)
    documents = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "text_hashes", _words_of("first"))).alias("place", "doc"))
    documents = documents.select("segment", "place", "doc.doc_ids", "doc.text_hashes", "doc.n_words")
    documents = documents.toDF("segment", "place", "doc_id", "text_hash", "n_words")
    if hits is None:
        empty = [F.array().cast(f"array<{kind}>").alias(name) for name, kind in (("items", item_kind), ("spans", "struct<start: bigint, end: bigint>"))]
        return documents.select("doc_id", "text_hash", "n_words", *empty)
    named = hits.select("segment", "place", F.explode("queries").alias("query")).join(owners.select("query", "item_id"), "query")
    spans = hits.select("segment", "place", "spans", F.lit(None).cast(item_kind).alias("item_id"))
    items = named.select("segment", "place", F.lit(None).cast(hits.schema["spans"].dataType).alias("spans"), "item_id")
    hits = spans.unionByName(items).groupBy("segment", "place").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.collect_set("item_id").alias("items")
    )
    found = documents.join(hits, ["segment", "place"], "left")
    return found.select(
        "doc_id", "text_hash", "n_words", *(F.coalesce(c, F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("items", "spans"))
    )


def _words_of(first: str):
    sizes = F.transform(F.sequence(F.lit(1), F.size(first) - 1), lambda i: (F.get(first, i) - F.get(first, i - 1)).cast("long"))
    return F.when(F.size(first) > 1, sizes).alias("n_words")


def covered(spans):
    """Words in at least one of the sorted ``spans``."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reach")),
        lambda a, s: F.struct(
            (a["total"] + F.greatest(s["end"] - F.greatest(s["start"], a["reach"]), F.lit(0))).alias("total"),
            F.greatest(a["reach"], s["end"]).alias("reach"),
        ),
        lambda a: a["total"],
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """``search`` for the windows of benchmark ``items``, with ``n_hit``, the words
    in any match, and ``contaminated``: at least ``percent`` of all words are."""
    found = search(build_index(docs), windows_of(items, window))
    found = found.withColumn("n_hit", covered("spans"))
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words")))


def without_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """The rows of ``docs`` that are not contaminated. A row is known by its id,
    which may be null, and its text."""
    bad = contamination(docs, items, window, percent).filter("contaminated")
    bad = bad.select("doc_id", "text_hash").distinct().alias("bad")
    docs = docs.alias("docs")
    same = (F.xxhash64("docs.text") == F.col("bad.text_hash")) & F.col("docs.doc_id").eqNullSafe(F.col("bad.doc_id"))
    return docs.join(bad, same, "left_anti")
