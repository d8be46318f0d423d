"""Hard-negative mining with exact integer scores by residue matrices.

Scores are inner products of integer vectors. Matrices of anchors and of rows are
reduced modulo a few primes below 256 and multiplied in float32: residues lie
between -125 and 125, so that sums over ``DEPTH`` components stay below 2**24 and
are exact. Chinese remaindering of the products gives the signed scores; there are
as many primes as the longest vector asks for.

Anchors and rows are hashed into blocks, and each pair of blocks meets in a group
of its own that a task multiplies in tiles. A group hands on the best few rows of
each anchor, from which windows select: first the positives, then, in a second
product, the negatives whose scores lie in the band of a positive's.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, stage_counted

PRIMES = (251, 241, 239, 233, 229, 227, 223, 211)
#: Components in one float32 product: 1024 * 125 * 125 < 2**24.
DEPTH = 1024
#: Scores stay below this; eight primes tell 2**62 of them apart.
_SCORE_BITS = 59
BLOCK_ROWS, BLOCK_ANCHORS = 1 << 15, 1 << 10
#: Smaller tables are cut into up to so many blocks of at least so many rows.
_LEAST_BLOCKS, _LEAST_ROWS = 32, 1 << 10
TILE_ROWS = 1 << 11


def whole_numbers(vector: Column, scale: int = 256) -> Column:
    """``floor(scale * x)`` of each component. Ones beyond the square root of
    2**59 / dimensions count as that, so that no score passes 2**59."""
    most = F.floor(F.sqrt(F.lit(2.0**_SCORE_BITS) / F.greatest(F.size(vector), F.lit(1))))

    def whole(x: Column) -> Column:
        scaled = F.floor(F.lit(float(scale)) * x.cast("double"))
        return F.greatest(-most, F.least(most, scaled)).cast("int")

    return F.transform(vector, whole)


def is_usable(label: str, vector: str) -> Column:
    """The row has a label, and a vector without null or non-finite components."""

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, finite)


# --- exact products -------------------------------------------------------


def primes_for(bound: float) -> tuple[int, ...]:
    """Primes whose product passes twice the bound of the scores' size."""
    product = 1
    for count, prime in enumerate(PRIMES, 1):
        product *= prime
        if product > 2 * bound * (1 + 1e-9) + 2:
            return PRIMES[:count]
    raise ValueError(f"scores up to {bound} are too large")


def residues(matrix: np.ndarray, primes: tuple[int, ...]) -> list[np.ndarray]:
    """The matrix modulo each prime, between minus and plus half of it."""
    out = []
    for prime in primes:
        reduced = (matrix % prime).astype(np.float32)
        reduced[reduced > prime // 2] -= prime
        out.append(reduced)
    return out


def products(left: list[np.ndarray], right: list[np.ndarray], primes: tuple[int, ...]) -> np.ndarray:
    """The exact integers ``left @ right.T`` from both matrices' residues."""
    digits: list[np.ndarray] = []
    for k, (prime, a, b) in enumerate(zip(primes, left, right)):
        total = np.zeros((len(a), len(b)), np.int32)
        for low in range(0, a.shape[1], DEPTH):
            total += (a[:, low : low + DEPTH] @ b[:, low : low + DEPTH].T).astype(np.int32) % prime
        total %= prime
        # Mixed radix: what is left after the digits so far, divided by the primes so far.
        for digit, earlier in zip(digits, primes[:k]):
            total = (total - digit) * np.int32(pow(earlier, -1, prime)) % prime
        digits.append(total)
    out, radix = np.zeros(digits[0].shape, np.int64), 1
    for digit, prime in zip(digits, primes):
        out += digit.astype(np.int64) * radix
        radix *= prime
    out[out > radix // 2] -= radix
    return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with zeros."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


# --- groups ---------------------------------------------------------------


def _leading(anchors: np.ndarray, scores: np.ndarray, place: np.ndarray, count: int) -> np.ndarray:
    """Which entries are among the first ``count`` of their anchor, in that order."""
    order = np.lexsort((place, -scores, anchors))
    of = anchors[order]
    starts = np.searchsorted(of, of)
    return order[np.arange(len(of)) - starts < count]


def _best(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of at least the first ``count`` entries of each row."""
    if scores.shape[1] <= count:
        return tuple(x.ravel() for x in np.indices(scores.shape))
    least = np.partition(scores, scores.shape[1] - count, axis=1)[:, scores.shape[1] - count]
    return np.nonzero(scores >= least[:, None])


class _Group:
    """Rows and anchors of a pair of blocks; rows are in the order of ties."""

    def __init__(self, rows: pa.Table, anchors: pa.Table, primes: tuple[int, ...]):
        order = pc.sort_indices(rows, sort_keys=[("id", "ascending"), ("row", "ascending")], null_placement="at_end")
        self.rows, self.anchors, self.primes = rows.take(order), anchors, primes
        sizes = [pc.max(pc.list_value_length(t["vector"])).as_py() or 0 for t in (rows, anchors)]
        self.width = max(1, *sizes)
        self.row, self.anchor_row = self.rows["row"].to_numpy(), anchors["row"].to_numpy()
        labels = pa.chunked_array(self.rows["label"].chunks + anchors["label"].chunks, pa.string()).combine_chunks()
        codes = labels.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        self.label, self.anchor_label = codes[: len(self.rows)], codes[len(self.rows) :]
        self.right = residues(_matrix(anchors["vector"], self.width), primes)

    def tiles(self, anchors: np.ndarray, rows: np.ndarray):
        """Scores of the given anchors with tiles of the given rows."""
        right = [r[anchors] for r in self.right]
        for low in range(0, len(rows), TILE_ROWS):
            tile = rows[low : low + TILE_ROWS]
            left = residues(_matrix(self.rows["vector"].take(pa.array(tile)), self.width), self.primes)
            yield tile, products(right, left, self.primes)

    def found(self, anchors: np.ndarray, places: np.ndarray, scores: np.ndarray, **more: pa.Array) -> pa.Table:
        chosen = self.rows.select(["row", "id"]).take(pa.array(places))
        columns = {"anchor_row": pa.array(self.anchor_row[anchors]), "row": chosen["row"], "id": chosen["id"]}
        return pa.table({**columns, "score": pa.array(scores, pa.int64()), **more})


def _positives_of(count: int, primes: tuple[int, ...]):
    def positives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        group = _Group(rows, anchors, primes)
        held = [(np.zeros(0, np.int64),) * 3]
        for label in np.unique(group.anchor_label):
            mine = np.flatnonzero(group.anchor_label == label)
            for tile, scores in group.tiles(mine, np.flatnonzero(group.label == label)):
                own = group.anchor_row[mine][:, None] == group.row[tile][None, :]
                scores[own] = np.iinfo(np.int64).min
                a, b = _best(scores, count)
                keep = ~own[a, b]
                a, b = a[keep], b[keep]
                held.append((mine[a], tile[b], scores[a, b]))
        a, places, scores = (np.concatenate(x) for x in zip(*held))
        first = _leading(a, scores, places, count)
        return group.found(a[first], places[first], scores[first])

    return positives


def _negatives_of(count: int, low: int, high: int, primes: tuple[int, ...]):
    def negatives(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        group = _Group(rows, anchors, primes)
        bands = [[(s, -(-low * s // 100), high * s // 100) for s in scores] for scores in anchors["positive_scores"].to_pylist()]
        most = max(map(len, bands), default=0)
        empty = (0, 1, 0)
        bands = np.array([b + [empty] * (most - len(b)) for b in bands], np.int64).reshape(len(bands), most, 3)
        held = [(np.zeros(0, np.int64),) * 4]
        every = np.arange(len(group.anchor_row))
        if most:
            lowest = np.where(bands[:, :, 1] <= bands[:, :, 2], bands[:, :, 1], np.iinfo(np.int64).max).min(1)
            highest = np.where(bands[:, :, 1] <= bands[:, :, 2], bands[:, :, 2], np.iinfo(np.int64).min).max(1)
            for tile, scores in group.tiles(every, np.arange(len(group.row))):
                near = (scores >= lowest[:, None]) & (scores <= highest[:, None])
                near &= group.anchor_label[:, None] != group.label[tile][None, :]
                a, b = np.nonzero(near)
                found = scores[a, b]
                for k in range(most):
                    inside = np.flatnonzero((found >= bands[a, k, 1]) & (found <= bands[a, k, 2]))
                    first = inside[_leading(a[inside], found[inside], b[inside], count)]
                    held.append((a[first], tile[b[first]], found[first], np.full(len(first), k)))
        a, places, scores, band = (np.concatenate(x) for x in zip(*held))
        first = _leading(a * max(1, most) + band, scores, places, count)
        a, band = a[first], band[first]
        positive = bands[a, band, 0] if most else a
        return group.found(a, places[first], scores[first], positive_score=pa.array(positive, pa.int64()))

    return negatives


# --- selection ------------------------------------------------------------


def _blocks(rows: int, per_block: int, least: int = 1) -> int:
    return max(-(-rows // per_block), min(least, -(-rows // _LEAST_ROWS)), 1)


def _first(rows: DataFrame, count: int, *of: str) -> DataFrame:
    """The first ``count`` rows of each anchor by score, then id, with their ``rank``."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def mine(
    rows: DataFrame,
    anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
) -> DataFrame:
    """Negatives of each anchor and positive: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score`` and ``negative_score``.

    ``rows`` have an ``id``, a ``label`` and a ``vector`` of whole numbers
    (``whole_numbers``); rows for which ``anchor`` holds are anchors. A score is the
    inner product, over the shorter one's components if lengths differ. An anchor's
    positives are its first ``positives`` other rows of its label, by score, ties by
    the smaller id, null last. The negatives of a positive are the first ``negatives``
    rows of other labels whose score is at least ``low`` and at most ``high`` percent of
    the positive's. Rows that repeat an id are rows of their own; an anchor without
    positives or negatives has no rows, and neither have empty tables. Other columns
    are left out. Rows without label or vector, and null components, are not allowed.
    """
    kind = rows.schema["id"].dataType.simpleString()
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    held, seen = stage_counted(
        rows.select(
            F.monotonically_increasing_id().alias("row"),
            "id",
            F.col("label").cast("string").alias("label"),
            "vector",
            F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        ),
        "mining-rows",
        anchors=F.count_if("is_anchor"),
        longest=F.max(squares),
    )
    primes = primes_for(seen["longest"] or 0.0)
    row_blocks, anchor_blocks = _blocks(seen["rows"], BLOCK_ROWS, _LEAST_BLOCKS), _blocks(seen["anchors"], BLOCK_ANCHORS)

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    fields = ["row", "id", "label", "vector"]
    left = held.select(*fields, block(row_blocks).alias("row_block"), every(anchor_blocks).alias("anchor_block"))
    # Renamed, so that the two sides of a group have columns of their own.
    anchors = held.filter("is_anchor").select(*fields).toDF(*[f"{f}_" for f in fields]).toDF(*fields)

    def meet(those: DataFrame, function, schema: str) -> DataFrame:
        right = those.select("*", block(anchor_blocks).alias("anchor_block"), every(row_blocks).alias("row_block"))
        pair = ["anchor_block", "row_block"]
        return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInArrow(function, schema)

    found = f"anchor_row long, row long, id {kind}, score long"
    near = _first(meet(anchors, _positives_of(positives, primes), found), positives, "anchor_row")
    near = stage(near.select("anchor_row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "mining-positives")
    wanted = near.groupBy("anchor_row").agg(F.collect_set("positive_score").alias("positive_scores"))
    asking = anchors.join(wanted, anchors["row"] == wanted["anchor_row"]).drop("anchor_row")
    far = meet(asking, _negatives_of(negatives, low, high, primes), f"{found}, positive_score long")
    far = _first(far, negatives, "anchor_row", "positive_score")
    far = far.select("anchor_row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
    out = near.join(far, ["anchor_row", "positive_score"]).join(names, "anchor_row")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
