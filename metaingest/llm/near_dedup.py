"""MinHash near-deduplication with circulant permutations.

A text's set is that of its distinct word shingles. One permutation scatters
the shingles over 64-bit places; the other one, shifted by a fixed step for
each coordinate, gives the whole signature, so a signature of ``COORDINATES``
costs two permutations. Signatures are cut into ``BANDS``; texts that share a
band are candidates, and a link counts once the full sets reach the similarity.

Only components are asked for, so a bucket need not try all its pairs:

1. Texts with equal sets are one node. They are linked as they are.
2. In each bucket every node is compared with the smallest. The links give
   first components.
3. Buckets that still hold more than one component compare the signatures of
   the nodes outside the smallest node's component with those of all nodes of
   other components, in blocks of ``BLOCK`` nodes, each block pair in a group of
   its own. A pair is looked at in the first band that it shares. Nodes with a
   likely partner then meet there with their texts, and all sets of a block
   are intersected at once. Only links that join components leave a block, at
   most one for each node; pairs are never written out.

Pairs whose share of equal coordinates is below ``LEAST_EQUAL`` are not likely:
a pair at the similarity falls below with probability 1e-6.

With 32 bands of 5, a pair at 0.8 shares a band with probability 1 - 3e-6, and
more similar ones yet more surely. Sets are compared as 64-bit hashes of their
shingles. A hot bucket is spread over the block pairs, and no node is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import words as w
from .components import components

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Of the signature's coordinates, so many agree in a likely pair.
LEAST_EQUAL = 104
BLOCK = 256
_SHIFT = np.uint64(0xD1342543DE82EF95)
_SHIFTS = np.arange(COORDINATES, dtype=np.uint64) * _SHIFT
_CHUNK = 1 << 15


def shingle_sets(texts: w.Texts, length: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text. One with fewer words has the
    whole sequence as its only shingle, one without words has none."""
    words = w.find_words(texts)
    hashes = w.hash_spans(texts.data, words.starts, words.ends)
    runs = w.chain(hashes, length)
    out = []
    for low, high in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if high - low >= length:
            out.append(np.unique(runs[low : high - length + 1]))
        else:
            out.append(w.chain(hashes[low:high], high - low) if high > low else runs[:0])
    return out


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """One row of at most ``COORDINATES`` for each set that is not empty."""
    out = np.empty((len(sets), coordinates), np.uint64)
    low = 0
    while low < len(sets):
        high, size = low + 1, len(sets[low])
        while high < len(sets) and size + len(sets[high]) <= _CHUNK:
            size += len(sets[high])
            high += 1
        first = np.concatenate(([0], np.cumsum([len(s) for s in sets[low : high - 1]]))).astype(np.int64)
        scattered = w.mix(np.concatenate(sets[low:high]))
        for k in range(coordinates):
            out[low:high, k] = np.minimum.reduceat(_permuted(scattered - _SHIFTS[k]), first)
        low = high
    return out


def _permuted(places: np.ndarray) -> np.ndarray:
    """The permutation that is shifted: a bijection of 64-bit integers."""
    places ^= places >> np.uint64(32)
    places *= np.uint64(0xD6E8FEB86659FD93)
    places ^= places >> np.uint64(32)
    return places


def _digest(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    first = w.mix(shingles).sum(dtype=np.uint64)
    second = w.mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return first.tobytes() + second.tobytes()


def _sign(length: int):
    @w.releasing
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, bands, coordinates = [], [], [], []
            for _, _, texts in w.text_slices(batch.column("text")):
                sets = shingle_sets(texts, length)
                full = [s for s in sets if len(s)]
                signed = signatures(full)
                rows = iter(zip(band_keys(signed).tolist(), (signed & np.uint64(0xFF)).astype(np.uint8)))
                for found in sets:
                    sizes.append(len(found))
                    nodes.append(_digest(found) if len(found) else None)
                    keys, low_bytes = next(rows) if len(found) else (None, None)
                    bands.append(keys)
                    coordinates.append(None if low_bytes is None else low_bytes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(coordinates, pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "node", "bands", "coordinates"],
            )

    return sign


def band_keys(signed: np.ndarray) -> np.ndarray:
    """A key for each band, different from those of other bands."""
    bands = signed.shape[1] // ROWS
    keys = np.zeros((len(signed), bands), np.uint64)
    for row in range(ROWS):
        keys = w.mix(keys + signed[:, row::ROWS] + np.arange(bands, dtype=np.uint64))
    return keys.view(np.int64)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``.

    Two rows are linked if ``100 * intersection >= percent * union`` holds of
    their sets. ``component_id`` is the smallest ``doc_id`` that links lead to,
    the row's own included; a null ``doc_id`` is never the smallest. Null and
    empty texts, and those without words, are linked with nothing. Rows may
    repeat and ids may be null; other columns are left out.
    """
    return _placed(docs, shingle, percent).select("doc_id", "n_shingles", F.coalesce("least.doc_id", "doc_id").alias("component_id"))


def _placed(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Every row with its ``text_hash`` and the ``least`` row of its component: the
    smallest ``doc_id``, null as the last, and of its texts the smallest hash.
    A text without words has no ``least``."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = stage(
        keyed.mapInArrow(
            _sign(shingle),
            f"doc_id {kind}, text_hash long, n_shingles long, node binary, bands array<long>, coordinates binary",
        ),
        "dedup-signed",
    )
    nodes = stage(signed.filter("node is not null").dropDuplicates(["node"]), "dedup-nodes")
    members = _buckets(nodes)
    stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = _similar(_likely_of(stars, nodes, percent), nodes, keyed, shingle, percent)
    joined = stage(components(links), "dedup-components")
    known = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    joined = components(known.unionByName(_crossing(members, joined, nodes, keyed, shingle, percent)))

    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    of_node = signed.filter("node is not null").groupBy("node").agg(F.min(row).alias("least")).join(joined, "node", "left")
    of_node = of_node.withColumn("component", F.coalesce("component", "node"))
    least = of_node.groupBy("component").agg(F.min("least").alias("least"))
    ids = of_node.drop("least").join(least, "component").select("node", "least")
    return signed.select("doc_id", "text_hash", "n_shingles", "node").join(ids, "node", "left").drop("node")


def _buckets(nodes: DataFrame) -> DataFrame:
    """Members of each bucket with two nodes or more, with its smallest node."""
    rows = nodes.select("node", "n_shingles", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return stage(rows.join(shared, "bucket"), "dedup-buckets")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _likely_of(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose signatures and sizes allow the similarity."""
    signed = nodes.select("node", "n_shingles", "coordinates")
    both = pairs.join(signed.toDF("a", "size_a", "coordinates_a"), "a").join(signed.toDF("b", "size_b", "coordinates_b"), "b")
    both = both.filter(_sizes_fit(F.col("size_a"), F.col("size_b"), percent)).select("a", "b", "coordinates_a", "coordinates_b")
    return stage(both.mapInArrow(_likely, "a binary, b binary"), "dedup-likely")


def _similar(likely: DataFrame, nodes: DataFrame, keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    texts = _texts_of(likely.select(F.explode(F.array("a", "b")).alias("node")), nodes, keyed)
    held = likely.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    @w.releasing
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for low, high, left in w.text_slices(batch.column("text_a")):
                for _, _, right in w.text_slices(batch.column("text_b").slice(low, high - low), 1 << 62):
                    for x, y in zip(shingle_sets(left, shingle), shingle_sets(right, shingle)):
                        common = len(np.intersect1d(x, y, assume_unique=True))
                        keep.append(100 * common >= percent * (len(x) + len(y) - common))
            kept = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            yield kept

    return stage(held.mapInArrow(confirm, "a binary, b binary"), "dedup-links")


def _texts_of(wanted: DataFrame, nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """``node`` and ``text``, once for each node of ``wanted``."""
    where = wanted.distinct().join(nodes.select("node", "doc_id", "text_hash"), "node").toDF("node", "wanted_id", "wanted_hash")
    texts = keyed.join(where, (F.col("text_hash") == F.col("wanted_hash")) & F.col("doc_id").eqNullSafe(F.col("wanted_id")))
    return texts.select("node", "text").dropDuplicates(["node"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), COORDINATES)


@w.releasing
def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        equal = (_matrix(batch.column("coordinates_a")) == _matrix(batch.column("coordinates_b"))).sum(1)
        yield batch.select(["a", "b"]).filter(pa.array(equal >= LEAST_EQUAL))


def _crossing(members: DataFrame, joined: DataFrame, nodes: DataFrame, keyed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between nodes that share a bucket but no component so far."""
    named = joined.select("node", "component")
    known = members.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    main = known.filter("node = pivot").select("bucket", F.col("component").alias("main"))
    split = known.join(main, "bucket").withColumn("outside", F.col("component") != F.col("main"))
    mixed = split.groupBy("bucket").agg(F.sum(F.col("outside").cast("long")).alias("n_outside")).filter("n_outside > 0")
    rows = split.join(mixed, "bucket").join(nodes.select("node", "coordinates", "bands"), "node")
    # Nodes outside are the rows of a block pair, all nodes its columns.
    row_blocks, column_blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n_outside", "size"))
    own = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    fields = ["bucket", "node", "n_shingles", "component", "coordinates", "bands"]
    as_rows = rows.filter("outside").select(
        *fields, (own % row_blocks).alias("i"), F.explode(F.sequence(F.lit(0), column_blocks - 1)).alias("j"), F.lit(True).alias("is_row")
    )
    as_columns = rows.select(
        *fields, F.explode(F.sequence(F.lit(0), row_blocks - 1)).alias("i"), (own % column_blocks).alias("j"), F.lit(False).alias("is_row")
    )
    block = ["bucket", "i", "j"]
    likely = as_rows.unionByName(as_columns.select(as_rows.columns)).groupBy(*block).applyInArrow(
        _with_partners(percent), "bucket long, i int, j int, node binary, component binary, is_row boolean"
    )
    likely = stage(likely, "dedup-crossing")
    held = likely.join(_texts_of(likely.select("node"), nodes, keyed), "node").groupBy(*block)
    return stage(held.applyInArrow(_links(shingle, percent), "a binary, b binary"), "dedup-links")


def _with_partners(percent: int):
    """The nodes of a block pair that have a likely partner of another component,
    with which no earlier band is shared."""

    def with_partners(block: pa.Table) -> pa.Table:
        is_row = block["is_row"].to_numpy()
        coordinates = _matrix(block["coordinates"])
        bands = block["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        here = int((bands[0] == block["bucket"][0].as_py()).argmax())
        sizes, component = block["n_shingles"].to_numpy(), np.unique(block["component"].to_pylist(), return_inverse=True)[1]
        columns = np.flatnonzero(~is_row)
        keep = np.zeros(len(is_row), bool)
        for row in np.flatnonzero(is_row):
            least, most = np.minimum(sizes[columns], sizes[row]), np.maximum(sizes[columns], sizes[row])
            near = columns[(component[columns] != component[row]) & (100 * least >= percent * most)]
            near = near[~(bands[near, :here] == bands[row, :here]).any(1)]
            near = near[(coordinates[near] == coordinates[row]).sum(1) >= LEAST_EQUAL]
            keep[near] = True
            keep[row] = len(near) > 0
        return block.select(["bucket", "i", "j", "node", "component", "is_row"]).filter(pa.array(keep))

    return with_partners


def _links(shingle: int, percent: int):
    """Links between rows and columns of a block pair, just enough to join their components."""

    def links(block: pa.Table) -> pa.Table:
        is_row = block["is_row"].to_numpy()
        sets: list[np.ndarray] = []
        for _, _, texts in w.text_slices(block["text"].combine_chunks()):
            sets += shingle_sets(texts, shingle)
        rows, columns = np.flatnonzero(is_row), np.flatnonzero(~is_row)
        sizes = np.array([len(s) for s in sets], np.int64)
        common = _intersections([sets[i] for i in rows], [sets[i] for i in columns])
        similar = 100 * common >= percent * (sizes[rows][:, None] + sizes[columns][None, :] - common)
        component = np.unique(block["component"].to_pylist(), return_inverse=True)[1]
        node, a, b = block["node"].to_pylist(), [], []
        for row, column in zip(*np.nonzero(similar)):
            one, other = component[rows[row]], component[columns[column]]
            if one != other:
                component[component == other] = one
                a.append(node[rows[row]])
                b.append(node[columns[column]])
        del sets, common, similar
        w.release()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return links


def _intersections(rows: list[np.ndarray], columns: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all rows with all columns."""
    common = np.zeros((len(rows), len(columns)), np.float32)
    if not len(rows) or not len(columns):
        return common.astype(np.int64)
    values = np.concatenate([*rows, *columns])
    of = np.repeat(np.arange(len(rows) + len(columns)), [len(s) for s in (*rows, *columns)])
    distinct, number, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times > 1  # others are in one set only
    rank = np.cumsum(shared) - 1
    keep = shared[number]
    of, number = of[keep], rank[number[keep]]
    order = np.argsort(number, kind="stable")
    of, number = of[order], number[order]
    step = 1 << 13
    for low in range(0, int(shared.sum()), step):
        part = slice(*np.searchsorted(number, [low, low + step]))
        held = np.zeros((len(rows) + len(columns), step), np.float32)
        held[of[part], number[part] - low] = 1
        common += held[: len(rows)] @ held[len(rows) :].T
    return np.rint(common).astype(np.int64)


def keep_one(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, and all rows without words.

    It has the smallest ``doc_id``, or none if no row of the component has one; of
    several texts under it the one with the smallest hash stays. Only rows that
    repeat both a ``doc_id`` and its text stay together, as one document.
    """
    same = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_hash") == F.col("least.text_hash"))
    others = _placed(docs, shingle, percent).filter("least is not null").filter(~same)
    others = stage(others.select(F.col("doc_id").alias("other_id"), F.col("text_hash").alias("other_text")).distinct(), "dedup-others")
    text_hash = F.xxhash64("text")
    match = F.col("doc_id").eqNullSafe(F.col("other_id")) & (text_hash == F.col("other_text"))
    kept = docs.join(others, match, "left_anti")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Copies without an id differ in nothing that a join could tell apart.
    unnamed = kept.filter(F.col("doc_id").isNull() & worded).dropDuplicates(["text"])
    return kept.filter(F.col("doc_id").isNotNull() | ~worded).unionByName(unnamed)
