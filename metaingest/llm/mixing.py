"""Mixing sources to target weights by entropy balancing.

A document's rate says how often the mix takes it. Of all rates between 0 and
``cap`` that give each source its target of words, the ones of greatest entropy
relative to rate 1 are exponential tilts of it,

    rate = cap * e / (cap - 1 + e),  e = exp(multiplier * size / scale),

with one multiplier a source, where the convex dual has its least value. Newton's
method finds them: a step is one aggregate over all sources, of a table with one
row for each source and size, which is all that the dual needs to know of the
documents. A step that leaves the interval known to hold the multiplier is
replaced by one inside it.

Rates become copies by cumulative rounding over a source's sizes, the largest
first, and what is then left of the target is taken from, or given to, the largest
sizes that fit into it. Documents of one size share their copies as evenly as
whole numbers allow, in the order of a hash of their id. Nothing is drawn, and sums
are of whole numbers, whose order does not matter, so a rerun takes the same.

Only DataFrame functions are used. A source's distinct sizes are the most that one
task sorts; ``n`` of them need ``n * n / 2`` words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, stage_counted

#: Weights of the sources in order, repeated.
WEIGHTS = (5, 2, 1)
#: No document is taken more often, and no target passes this many times its source's size.
CAP = 3
#: Share of the target to which the rates meet it.
TOLERANCE = 1e-6
#: Rates count in whole numbers of this fraction.
UNIT = 1 << 24
_STEPS_PER_ROUND = 4
_MOST_ROUNDS = 40
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of the text, none if it is null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _source_key(source: str) -> Column:
    """The source as text that sorts by code point, null last, and equals itself."""
    text = F.col(source).cast("string")
    return F.when(text.isNull(), "n").otherwise(F.concat(F.lit("k"), text))


# --- targets --------------------------------------------------------------


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``, gapless from 0 in the order of ``source_key``.

    Sorted in parts, and numbered within each after the sizes of those before it."""
    in_order = stage(
        sources.sort("source_key").withColumn("part", F.spark_partition_id()).withColumn("within", F.monotonically_increasing_id()),
        "mix-order",
    )
    parts = in_order.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("within").alias("first"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    parts = parts.withColumn("before", before).drop("size")
    return in_order.join(parts, "part").withColumn("place", F.col("before") + F.col("within") - F.col("first")).drop(
        "part", "within", "first", "before"
    )


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sources`` (``source_key``, ``source_size``) with ``target``.

    The targets sum to all sizes. They are in proportion to the weights but for
    those that would pass ``cap`` times their source's size and stop there.
    """
    ranked = _ranked(sources)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    held, seen = stage_counted(ranked.select("*", weight.alias("weight")).drop("place"), "mix-sources", words=F.sum("source_size"))
    words, free, fixed, rate = seen["words"] or 0, None, 0.0, 0.0
    most = F.col("source_size") * float(cap)
    # Each round stops the sources that their share would lift above their most,
    # and shares what these leave among the others.
    while True:
        stopped = F.lit(False) if free is None else F.col("weight") * F.lit(rate) > most
        sums = held.agg(
            F.coalesce(F.sum(F.when(stopped, most)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~stopped, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(~stopped).alias("free"),
        ).first()
        if free == sums["free"] or not sums["free"]:
            break
        free, fixed = sums["free"], sums["fixed"]
        rate = (words - fixed) / sums["weight"]
    return held.withColumn("target", F.least(most, F.col("weight") * F.lit(rate))).drop("weight")


# --- rates ----------------------------------------------------------------


def _full(cap: int) -> Column:
    return F.col("target") >= F.col("source_size") * cap * (1 - TOLERANCE)


def _rate(multiplier: Column, cap: int) -> Column:
    """The tilted rate of a row, in units. All rows of a source that can but reach its
    target at the most, or whose target is nothing, have the same."""
    tilt = F.exp(F.least(F.lit(700.0), F.greatest(F.lit(-700.0), multiplier * F.col("size") / F.col("scale"))))
    rate = F.when(_full(cap), F.lit(float(cap))).when(F.col("target") <= 0, F.lit(0.0)).otherwise(cap * tilt / (cap - 1 + tilt))
    return F.round(rate * UNIT).cast("long")


def _exact(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _newton(sizes: DataFrame, multipliers: DataFrame, cap: int) -> DataFrame:
    """The multipliers after one step, with the ``error`` of those before it."""
    carried = ["low", "high", "target", "source_size", "scale"]
    rows = sizes.join(multipliers, "source_key").withColumn("rate", _rate(F.col("multiplier"), cap))
    words = (F.col("rows") * F.col("size")).cast("decimal(20,0)")
    bend = F.round(F.col("rate") * (1 - F.col("rate") / (cap * UNIT))).cast("decimal(10,0)")
    taken = F.sum(_exact(words * F.col("rate").cast("decimal(10,0)")))
    slope = F.sum(_exact(words * F.col("size").cast("decimal(8,0)") * bend))
    summed = rows.groupBy("source_key").agg(
        (taken.cast("double") / UNIT).alias("taken"),
        (slope.cast("double") / UNIT / F.first("scale")).alias("slope"),
        F.first("multiplier").alias("multiplier"),
        *[F.first(c).alias(c) for c in carried],
    )
    at, beyond = F.col("multiplier"), F.col("taken") - F.col("target")
    summed = summed.withColumn("low", F.when(beyond < 0, at).otherwise(F.col("low")))
    summed = summed.withColumn("high", F.when(beyond > 0, at).otherwise(F.col("high")))
    step = F.when(F.col("slope") > 0, at - beyond / F.col("slope"))
    inside = F.coalesce(step > F.col("low"), step.isNotNull()) & F.coalesce(step < F.col("high"), step.isNotNull())
    halved = (F.col("low") + F.col("high")) / 2
    wider = F.when(beyond < 0, F.greatest(F.abs(at) * 2, F.lit(1.0))).otherwise(-F.greatest(F.abs(at) * 2, F.lit(1.0)))
    # A step may at most quadruple a multiplier; far out the dual is too flat to trust it.
    bounded = inside & (F.abs(step) <= 4 * F.greatest(F.abs(at), F.lit(1.0)))
    following = F.when(beyond == 0, at).when(bounded, step).otherwise(F.coalesce(halved, wider))
    fixed = (F.col("target") <= 0) | _full(cap)
    error = F.when(fixed, 0.0).otherwise(F.abs(beyond) / F.col("target"))
    return summed.select("source_key", following.alias("multiplier"), *carried, error.alias("error"), at.alias("solved"))


def rates(sizes: DataFrame, wanted: DataFrame, cap: int = CAP) -> DataFrame:
    """``sizes`` (``source_key``, ``size``, ``rows``) with ``target``, ``source_size`` and ``rate`` (in units).

    A source whose steps don't end in ``_MOST_ROUNDS`` rounds keeps its last ones;
    the rounding that follows makes up for what its rates miss.
    """
    words = F.col("rows") * F.col("size")
    squares = F.sum(_exact(words.cast("decimal(20,0)") * F.col("size").cast("decimal(18,0)"))).cast("double")
    scale = F.coalesce(squares / F.nullif(F.sum(words), F.lit(0)), F.lit(1.0))
    scales = sizes.groupBy("source_key").agg(scale.alias("scale"))
    nothing = F.lit(None).cast("double")
    state = wanted.join(scales, "source_key").select(
        "source_key", F.lit(0.0).alias("multiplier"), nothing.alias("low"), nothing.alias("high"), "target", "source_size", "scale"
    )
    for _ in range(_MOST_ROUNDS):
        for _ in range(_STEPS_PER_ROUND):
            state = _newton(sizes, state.drop("error", "solved"), cap)
        state, seen = stage_counted(state, "mix-multipliers", error=F.max("error"))
        if (seen["error"] or 0.0) <= TOLERANCE:
            break
    solved = state.select("source_key", "solved", "target", "source_size", "scale")
    rows = sizes.join(solved, "source_key").withColumn("rate", _rate(F.col("solved"), cap))
    return rows.drop("solved", "scale")


# --- copies ---------------------------------------------------------------


def _copies(rated: DataFrame, cap: int) -> DataFrame:
    """``copies``, a whole number for all rows of each source and size, that bring
    each source near its target."""
    largest_first = Window.partitionBy("source_key").orderBy(F.desc("size"))
    so_far = largest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole_source = Window.partitionBy("source_key")
    wanted = F.sum(F.col("rows") * F.col("rate")).over(so_far)
    rows = rated.withColumn("upto", F.floor((wanted + UNIT // 2) / UNIT).cast("long"))
    rows = rows.withColumn("copies", F.col("upto") - F.lag("upto", 1, 0).over(largest_first))
    most = F.col("rows") * cap
    rows = rows.withColumn("copies", F.greatest(F.lit(0), F.least(most, F.col("copies")))).drop("upto", "rate")
    rows, changed = stage(rows, "mix-copies"), True
    while changed:
        # The sizes that fit into what is missing (or too much), the largest first,
        # take as many copies as they can and as fit.
        missing = F.round(F.col("target")).cast("long") - F.sum(F.col("size") * F.col("copies")).over(whole_source)
        rows = rows.withColumn("missing", missing)
        room = F.when(F.col("missing") > 0, most - F.col("copies")).otherwise(F.col("copies"))
        room = F.when((F.col("size") > 0) & (F.col("size") <= F.abs("missing")), room).otherwise(F.lit(0))
        rows = rows.withColumn("room", room)
        before = F.sum(F.col("room") * F.col("size")).over(so_far) - F.col("room") * F.col("size")
        fitting = F.floor((F.abs("missing") - before) / F.greatest("size", F.lit(1))).cast("long")
        change = F.greatest(F.lit(0), F.least(F.col("room"), fitting))
        rows = rows.withColumn("change", change * F.signum(F.col("missing").cast("double")).cast("long"))
        rows, seen = stage_counted(
            rows.withColumn("copies", F.col("copies") + F.col("change")).drop("missing", "room"), "mix-copies", moved=F.sum(F.abs("change"))
        )
        rows, changed = rows.drop("change"), bool(seen["moved"])
    # One copy more or less, where that is nearer than none.
    missing = F.round(F.col("target")).cast("long") - F.sum(F.col("size") * F.col("copies")).over(whole_source)
    rows = rows.withColumn("missing", missing)
    room = F.when(F.col("missing") > 0, most - F.col("copies")).otherwise(F.col("copies"))
    off = F.when((room > 0) & (F.col("size") < 2 * F.abs("missing")), F.abs(F.abs("missing") - F.col("size")))
    rows = rows.withColumn("off", off)
    nearest = F.row_number().over(Window.partitionBy("source_key").orderBy(F.asc_nulls_last("off"), "size"))
    change = F.when((nearest == 1) & F.col("off").isNotNull(), F.signum(F.col("missing").cast("double")).cast("long")).otherwise(F.lit(0))
    return stage(rows.withColumn("copies", F.col("copies") + change).drop("missing", "off"), "mix-copies")


def mix(docs: DataFrame, source: str = "source", text: str = "text", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of
    every row of ``docs``.

    ``size`` is the number of words; a null or empty text has none and is taken with
    none. A source's weight follows from its place in the order of code points, the
    null source last. ``target`` is the source's, ``copies`` says how often the row is
    taken (at most ``cap`` times), ``taken`` is ``copies * size``. A source's ``taken``
    misses its target by less than the sizes that it has to mend it with: at most half a
    word if it has enough texts of one word. Rows that repeat an id and a size are
    rows of their own. Other columns are left out. No rows give none.
    """
    kinds = dict(docs.dtypes)
    named = docs.select("doc_id", F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    named = stage(named.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows")), "mix-rows")
    keyed = named.withColumn("source_key", _source_key("source"))
    sizes, seen = stage_counted(
        keyed.groupBy("source_key", "size").agg(F.sum("rows").alias("rows")), "mix-sizes", documents=F.sum("rows")
    )
    sources = sizes.groupBy("source_key").agg(F.sum(F.col("rows") * F.col("size")).alias("source_size"))
    wanted = stage(targets(sources, weights, cap), "mix-targets")
    copies = _copies(rates(sizes, wanted, cap), cap)

    # One size may be that of many rows, so they are numbered in parts.
    parts = max(1, int((seen["documents"] or 0) ** 0.5) // 8)
    spread = keyed.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    cell = ["source_key", "size"]
    counted = spread.groupBy(*cell, "part").agg(F.sum("rows").alias("part_rows"))
    by_part = Window.partitionBy(*cell).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = counted.join(copies.withColumnRenamed("rows", "cell_rows"), cell)
    counted = counted.withColumn("before_part", F.sum("part_rows").over(by_part) - F.col("part_rows"))
    by_hash = Window.partitionBy(*cell, "part").orderBy(F.xxhash64("doc_id", F.lit(7)), "doc_id")
    within = F.sum("rows").over(by_hash.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")
    rows = spread.withColumn("within", within).join(counted, [*cell, "part"])
    # Of a size's copies each row has the whole share, and the first rows one more.
    first = F.col("before_part") + F.col("within")
    extra = F.greatest(F.lit(0), F.least(F.col("rows"), F.col("copies") % F.col("cell_rows") - first))
    each = rows.withColumn("extra", extra).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    taken = F.floor(F.col("copies") / F.col("cell_rows")) + F.when(F.col("copy") <= F.col("extra"), 1).otherwise(0)
    return each.select(
        "doc_id",
        F.col("source").cast(kinds[source]).alias("source"),
        "size",
        "source_size",
        "target",
        taken.cast("long").alias("copies"),
        (taken * F.col("size")).cast("long").alias("taken"),
    )
