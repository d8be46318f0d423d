"""Hard negatives against all pairs in whole numbers, and odd vectors."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metaingest.llm import hard_negatives as hn

SCHEMA = "id long, label int, vector array<float>"


def plain(rows, is_anchor, positives=5, negatives=5):
    """All pairs, in Python's integers."""
    kept = []
    for place, (key, label, vector) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        most = math.isqrt(2**59 // max(1, len(vector)))
        kept.append((place, key, label, [max(-most, min(most, math.floor(256 * float(np.float32(x))))) for x in vector]))
    out = []
    for place, key, label, vector in kept:
        if not is_anchor(key):
            continue

        def order(row):
            return (-row[0], row[1] is None, row[1] or 0)

        scored = [(sum(a * b for a, b in zip(vector, v)), k, lab) for p, k, lab, v in kept if p != place]
        alike = sorted((r for r in scored if r[2] == label), key=order)[:positives]
        for score, positive, _ in alike:
            far = sorted((r for r in scored if r[2] != label and 80 * score <= 100 * r[0] <= 100 * score), key=order)
            out += [(key, positive, rank, r[1], score, r[0]) for rank, r in enumerate(far[:negatives], 1)]
    return sorted(out, key=str)


def mined(spark, rows, anchor):
    table = spark.createDataFrame(rows, SCHEMA).filter(hn.is_usable("label", "vector"))
    vectors = table.withColumn("vector", hn.whole_numbers(F.col("vector"))).withColumn("row", F.lit(3)).withColumn("score", F.lit("x"))
    return sorted(map(tuple, hn.mine(vectors, anchor).collect()), key=str)


def test_equals_all_pairs(spark, monkeypatch):
    draw = random.Random(4)
    center = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    rows = [(i, draw.choice([0, 0, 0, 1, 2, None]), [c + draw.gauss(0, 0.3) for c in draw.choice(center)]) for i in range(400)]
    rows += [(i % 40, 1, rows[5][2]) for i in range(60)]  # copies, and ids that repeat
    rows += [(None, 0, rows[0][2]), (500, 1, None), (501, 1, [None] * 6), (502, 1, [math.nan] * 6), (503, 0, [math.inf] * 6), (504, 0, [])]
    rows += [(505, 2, [1.0]), (506, 0, [3.0] * 40)]
    draw.shuffle(rows)
    want = plain(rows, lambda key: key is not None and key % 20 == 0)
    assert want == mined(spark, rows, F.col("id") % 20 == 0)
    for name, size in (("BLOCK_ROWS", 50), ("BLOCK_ANCHORS", 7), ("TILE_ROWS", 16)):
        monkeypatch.setattr(hn, name, size)
    assert want == mined(spark, rows, F.col("id") % 20 == 0)


def test_large_components(spark):
    rows = [(0, 1, [1e30, -2.0]), (1, 1, [3e38, 5.0]), (2, 0, [2e30, 1e6]), (3, 0, [-1e30, 0.0]), (4, 0, [2.2e6, 1.0])]
    assert mined(spark, rows, F.col("id") >= 0) == plain(rows, lambda key: True)


@pytest.mark.parametrize("size", [1, 250, 1 << 20, 1 << 27])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    a, b = rng.integers(-size, size + 1, (5, 2100)), rng.integers(-size, size + 1, (7, 2100))
    a[0] = b[0] = size if size < 1 << 20 else 0
    a, b = (np.where(np.arange(2100) < (1 << 59) // size**2, x, 0) for x in (a, b))
    primes = hn.primes_for(max(float((x.astype(float) ** 2).sum(1).max()) for x in (a, b)))
    found = hn.products(hn.residues(a, primes), hn.residues(b, primes), primes)
    assert found.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def test_too_large_scores_are_refused():
    with pytest.raises(ValueError):
        hn.primes_for(2.0**63)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, label int, vector array<int>")
    assert hn.mine(empty, F.col("id") % 2 == 0).collect() == []
    alone = spark.createDataFrame([(1, 1, [2]), (2, 2, [3])], empty.schema)
    assert hn.mine(alone, F.col("id") == 9).collect() == []
    assert hn.mine(alone, F.lit(True)).collect() == []
    assert hn.mine(alone, F.lit(None).cast("boolean")).collect() == []
