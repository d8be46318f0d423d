"""Chat formatting: cumulative snapshots collapsed into maximal conversations.

A log that stores a conversation after each turn holds it many times, each row
set a prefix of a longer one. Every turn gets a rolling hash of all turns up to
it; a conversation whose last hash is that of an earlier turn of some other one
is a prefix of it, and an anti-join drops it. Of equal conversations the
smallest id stays. The rest is rendered.

The rolling hash is a sum of turn hashes times powers of an odd number, so that
parts of a conversation can be hashed apart and put together: turns are sorted
over range partitions, and where a conversation goes on in the next partition,
what came before is added from a table of at most two entries a partition. A
long conversation is no single task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Characters of role and text by which turns are dealt: the driver samples these keys.
_PREFIX = 32


def _hashes() -> list[Column]:
    """128 bits for a turn's role and text; a null differs from an empty one."""
    what = [F.coalesce(F.col(c), F.lit("")) for c in ("role", "text")] + [F.col(c).isNull() for c in ("role", "text")]
    return [F.xxhash64(F.lit(seed), *what).alias(f"h{seed}") for seed in (1, 2)]


def _order() -> list[Column]:
    """Turns go by number, a null first, then by role and text, nulls last."""
    return [F.col("conv_id"), F.col("turn"), F.asc_nulls_last("role"), F.asc_nulls_last("text")]


def _ranges() -> list[Column]:
    """Short keys whose order is never against ``_order``."""
    keys = [F.col("conv_id"), F.col("turn"), F.col("role").isNull(), F.substring("role", 1, _PREFIX)]
    whole = F.coalesce(F.length("role") < _PREFIX, F.lit(True))
    return keys + [F.when(whole, F.col("text").isNull()), F.when(whole, F.substring("text", 1, _PREFIX))]


def _roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and rolling hashes of each turn, from its conversation's first turn in this task."""
    task = TaskContext.get().partitionId()
    last, position, rolled, power = None, 0, [0, 0], 1
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        h = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64).tolist() for c in ("h1", "h2")]
        out: list[list] = [[], [], []]
        for i, conversation in enumerate(ids):
            if conversation != last:
                last, position, rolled, power = conversation, 0, [0, 0], 1
            position += 1
            rolled = [(r + (x[i] | 1) * power) & _MASK for r, x in zip(rolled, h)]
            power = power * _ODD & _MASK
            out[0].append(position)
            out[1].append(rolled[0])
            out[2].append(rolled[1])
        columns = [pa.array([task] * len(ids), pa.int32()), batch.column("conv_id"), pa.array(out[0], pa.int64())]
        columns += [pa.array(np.array(c, np.uint64).view(np.int64)) for c in out[1:]]
        yield pa.RecordBatch.from_arrays(columns, ["task", "conv_id", "position", "p1", "p2"])


def prefixes(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``position`` and the hashes ``p1``, ``p2`` of the first
    ``position`` turns, for each distinct turn."""
    kind = conversations.schema["conv_id"].dataType.simpleString()
    turns = conversations.filter("conv_id is not null").select("conv_id", "turn", "role", "text").distinct()
    ordered = turns.repartitionByRange(*_ranges()).sortWithinPartitions(*_order()).select("conv_id", *_hashes())
    rolled = stage(ordered.mapInArrow(_roll, f"task int, conv_id {kind}, position long, p1 long, p2 long"), "chat-rolled")
    runs = rolled.groupBy("conv_id", "task").agg(F.max("position").alias("size"), F.max_by(F.struct("p1", "p2"), "position").alias("last"))
    several = runs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("tasks")).filter("tasks > 1").select("conv_id")
    before: dict[tuple, tuple[int, int, int]] = {}
    carried = {}
    for run in sorted(runs.join(several, "conv_id").collect(), key=lambda r: r.task):
        size, p1, p2 = carried.get(run.conv_id, (0, 0, 0))
        before[run.task, run.conv_id] = (size, p1, p2)
        power = pow(_ODD, size, 1 << 64)
        carried[run.conv_id] = (size + run.size, (p1 + power * run.last.p1) & _MASK, (p2 + power * run.last.p2) & _MASK)
    if not before:
        return rolled.drop("task")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("task", "conv_id", "position", "p1", "p2")))
            out = []
            for task, conversation, position, p1, p2 in rows:
                size, b1, b2 = before.get((task, conversation), (0, 0, 0))
                power = pow(_ODD, size, 1 << 64)
                out.append((position + size, (b1 + power * p1) & _MASK, (b2 + power * p2) & _MASK))
            moved = np.array(out, np.uint64).reshape(-1, 3).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(moved[:, k].copy()) for k in range(3))], ["conv_id", "position", "p1", "p2"]
            )

    return rolled.mapInArrow(add, f"conv_id {kind}, position long, p1 long, p2 long")


def maximal(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``n_turns`` of the conversations that are no proper prefix
    of another, one of each set of equal ones."""
    rolled = stage(prefixes(conversations), "chat-prefixes")
    whole = rolled.groupBy("conv_id").agg(F.max(F.struct("position", "p1", "p2")).alias("last"))
    whole = whole.select("conv_id", "last.*").groupBy("position", "p1", "p2").agg(F.min("conv_id").alias("conv_id"))
    ends = rolled.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    inner = rolled.join(ends, "conv_id").filter("position < n_turns").select("position", "p1", "p2").distinct()
    kept = whole.join(inner, ["position", "p1", "p2"], "left_anti")
    return kept.select("conv_id", F.col("position").alias("n_turns"))


def rendered_turn(role: Column, text: Column) -> Column:
    """A turn between markers; markers in the text itself are broken up."""
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit("<|im_start|>"), F.coalesce(role, F.lit("")), F.lit("\n"), plain, F.lit("<|im_end|>\n"))


def render(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``n_turns`` and the chat ``text`` of each maximal conversation.

    Turns go by ``turn``, a null first; those with one number by role and text,
    nulls last. Turns that repeat count once, rows without ``conv_id`` not at all;
    a null role or text is rendered as empty. Other columns are left out.
    """
    said = F.struct("turn", F.col("role").isNull().alias("no_role"), "role", F.col("text").isNull().alias("no_text"), "text")
    turns = conversations.select("conv_id", said.alias("said")).join(maximal(conversations), "conv_id")
    parts = F.transform(F.array_sort(F.collect_set("said")), lambda t: rendered_turn(t["role"], t["text"]))
    texts = turns.groupBy("conv_id", "n_turns").agg(F.array_join(parts, "").alias("text"))
    return texts.select("conv_id", "n_turns", "text")
