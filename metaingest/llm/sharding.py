"""K-d tree sharding at distributed weighted medians.

A node of the tree holds rows and a number of leaves to come. It is split
along its widest metadata dimension, at the value that leaves each side the
bytes of its leaves: the weighted median, or the third where three leaves are
left. Leaves reach the target bytes. Every dimension is scaled to 30 bits and
extended by a hash of the row, so a split can fall between rows with the same
value, however many there are.

A split value is found by histograms: one aggregate counts the bytes in
``BINS`` equal ranges for all nodes of a level at once, and the range with the
median is counted again, finer, until its bytes are below ``TOLERANCE`` of a
leaf. Only the histograms come to the driver; their size does not depend on the
table. Rows are numbered within the shards from counts for each input task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

BINS = 2048
TOLERANCE = 0.0005
_VALUE_BITS, _HASH_BITS = 30, 32


class Node(NamedTuple):
    """A leaf, if ``dimension`` is None: its number is the first shard."""

    first: int
    leaves: int
    dimension: str | None = None
    split: int = 0
    low: Node | None = None
    high: Node | None = None


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (none if null) and 8 for the row."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def _number(column: str, kind: str) -> Column:
    """Numbers by their logarithm, other values by their first eight bytes."""
    if kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal"):
        value = F.col(column).cast("double")
        number = F.signum(value) * F.log1p(F.abs(value))
    else:
        head = F.rpad(F.hex(F.substr(F.encode(F.col(column).cast("string"), "UTF-8"), F.lit(1), F.lit(6))), 12, "0")
        number = F.conv(head, 16, 10).cast("double")
    return F.when(F.isnan(number), None).otherwise(number)


def _keys(docs: DataFrame, dimensions: list[str], text: str) -> DataFrame:
    """One narrow row for each document with a sortable key for each dimension.
    Nulls come first."""
    kinds = dict(docs.dtypes)
    crc = F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8"))
    numbers = [_number(d, kinds[d]).alias(f"number_{i}") for i, d in enumerate(dimensions)]
    rows = docs.select(
        "doc_id", text_bytes(F.col(text)).alias("size"), crc.alias("text_crc32"), F.monotonically_increasing_id().alias("row"), *numbers
    )
    rows = stage(rows, "shard-rows")
    bounds = rows.agg(*[f(f"number_{i}").alias(f"{f.__name__}_{i}") for i in range(len(dimensions)) for f in (F.min, F.max)]).first()
    # Rows that are the same in all but their place differ in the last bits alone.
    hashed = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 40) * 256 + F.shiftrightunsigned(F.xxhash64("row"), 56)
    keys = []
    for i in range(len(dimensions)):
        low, high = bounds[f"min_{i}"], bounds[f"max_{i}"]
        width = (high - low) if low is not None and high > low else 1.0
        scaled = F.floor((F.col(f"number_{i}") - F.lit(low or 0.0)) / width * ((1 << _VALUE_BITS) - 2)) + 1
        keys.append((F.coalesce(scaled, F.lit(0)) * (1 << _HASH_BITS) + hashed).cast("long").alias(f"key_{i}"))
    return stage(rows.select("doc_id", "size", "text_crc32", "row", *keys), "shard-keys")


def _first_leaf(tree: Node) -> Column:
    """The leaf of a row, as nested conditions over its keys."""
    if tree.dimension is None:
        return F.lit(tree.first)
    return F.when(F.col(tree.dimension) < tree.split, _first_leaf(tree.low)).otherwise(_first_leaf(tree.high))


def _grown(tree: Node, splits: dict[int, tuple[str, int]]) -> Node:
    """The tree with leaves split; ``splits`` go by the leaf's first shard."""
    if tree.dimension is not None:
        return tree._replace(low=_grown(tree.low, splits), high=_grown(tree.high, splits))
    if tree.first not in splits:
        return tree
    half = tree.leaves // 2
    low, high = Node(tree.first, half), Node(tree.first + half, tree.leaves - half)
    return tree._replace(dimension=splits[tree.first][0], split=splits[tree.first][1], low=low, high=high)


def _leaves(tree: Node) -> list[Node]:
    return [tree] if tree.dimension is None else _leaves(tree.low) + _leaves(tree.high)


def kd_tree(keys: DataFrame, dimensions: int, leaves: int) -> Node:
    """A tree over ``key_0`` to ``key_n`` with leaves of near-equal ``size``."""
    tree = Node(0, leaves)
    while any(leaf.leaves > 1 for leaf in _leaves(tree)):
        open_leaves = {leaf.first: leaf for leaf in _leaves(tree) if leaf.leaves > 1}
        placed = keys.withColumn("leaf", _first_leaf(tree)).filter(F.col("leaf").isin(*open_leaves))
        spans = [f(f"key_{i}").alias(f"{f.__name__}_{i}") for i in range(dimensions) for f in (F.min, F.max)]
        ranges, totals = {}, {}
        for found in placed.groupBy("leaf").agg(F.sum("size").alias("size"), *spans).collect():
            widest = max(range(dimensions), key=lambda i: found[f"max_{i}"] - found[f"min_{i}"])
            ranges[found.leaf] = (f"key_{widest}", found[f"min_{widest}"], found[f"max_{widest}"] + 1)
            totals[found.leaf] = found.size
        for first in open_leaves.keys() - ranges.keys():  # no rows
            ranges[first], totals[first] = ("key_0", 0, 1), 0
        shares = {first: totals[first] * (leaf.leaves // 2) / leaf.leaves for first, leaf in open_leaves.items()}
        slack = {first: TOLERANCE * totals[first] / leaf.leaves for first, leaf in open_leaves.items()}
        tree = _grown(tree, _medians(placed, ranges, shares, slack))
    return tree


def _medians(placed: DataFrame, ranges: dict, shares: dict, slack: dict) -> dict[int, tuple[str, int]]:
    """For each leaf the key with ``shares`` bytes below it, near enough."""
    below = dict.fromkeys(ranges, 0)
    found = {}
    while ranges:
        where, bins = F.lit(False), F.lit(None).cast("long")
        for first, (key, low, high) in ranges.items():
            here = (F.col("leaf") == first) & (F.col(key) >= low) & (F.col(key) < high)
            width = -(-(high - low) // BINS)
            where, bins = where | here, F.when(here, F.floor((F.col(key) - low) / width)).otherwise(bins)
        counts: dict[int, dict[int, int]] = {first: {} for first in ranges}
        histogram = placed.filter(where).groupBy("leaf", bins.cast("int").alias("bin")).agg(F.sum("size").alias("size"))
        for row in histogram.collect():
            counts[row.leaf][row.bin] = row.size
        for first, (key, low, high) in list(ranges.items()):
            width = -(-(high - low) // BINS)
            for number in sorted(counts[first]):
                if below[first] + counts[first][number] > shares[first]:
                    break
                below[first] += counts[first][number]
            else:
                found[first] = (key, high)
                del ranges[first]
                continue
            low = low + number * width
            inside = counts[first][number]
            if width == 1 or inside <= slack[first]:
                nearer_above = shares[first] - below[first] > inside / 2
                found[first] = (key, low + width if nearer_above else low)
                del ranges[first]
            else:
                ranges[first] = (key, low, min(low + width, high))
    return found


def shard(
    docs: DataFrame, dimensions: list[str], shards: int | None = None, target_bytes: int | None = None, text: str = "text"
) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot`` of each row.

    The number of shards is given, or follows from ``target_bytes`` a shard.
    Slots run from 0 without gaps within a shard. Rows with a null are placed
    as well; rows that repeat are placed one by one. With fewer rows than
    shards, some shards are empty.
    """
    keys = _keys(docs, dimensions, text)
    if shards is None:
        total = keys.agg(F.sum("size")).first()[0] or 0
        shards = max(1, round(total / target_bytes))
    tree = kd_tree(keys, len(dimensions), shards)
    placed = keys.select("doc_id", "size", "text_crc32", "row", _first_leaf(tree).cast("int").alias("shard"))
    placed = placed.withColumn("task", F.shiftright("row", 33))
    return number_slots(placed)


def number_slots(placed: DataFrame) -> DataFrame:
    """A gapless ``slot`` within each shard: rows of earlier tasks come first,
    then those of the same task in their order."""
    counts = stage(placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("rows")), "shard-counts")
    before = counts.selectExpr(
        "shard", "task", "coalesce(sum(rows) over (partition by shard order by task rows between unbounded preceding and 1 preceding), 0) as before"
    )
    inside = placed.selectExpr("*", "row_number() over (partition by shard, task order by row) - 1 as place")
    numbered = inside.join(before, ["shard", "task"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("place")).alias("slot"))
