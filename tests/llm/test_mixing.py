"""Mixes against the plain dual and sharing of targets, and odd sources."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from metaingest.llm import mixing
from metaingest.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def plain_targets(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    order = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in stopped]
        share = total - sum(cap * sizes[s] for s in stopped)
        given = {s: weight[s] * share / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if given[s] > cap * sizes[s] * (1 + 1e-12)}
        if not above:
            return {**{s: cap * sizes[s] for s in stopped}, **given}
        stopped |= above


def plain_rates(sizes: list[int], target: float, cap=3) -> list[float]:
    """Rates of the tilt that meets the target, by halving."""
    import math

    scale = sum(s * s for s in sizes) / sum(sizes)
    low, high = -1e5, 1e5

    def rate(multiplier, size):
        tilt = math.exp(max(-700, min(700, multiplier * size / scale)))
        return cap * tilt / (cap - 1 + tilt)

    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if sum(s * rate(middle, s) for s in sizes) < target else (low, middle)
    return [rate(low, s) for s in sizes]


def corpus(spark, seed=2):
    draw = random.Random(seed)
    rows = []
    for i in range(1500):
        source = draw.choice(["hot"] * 6 + ["a", "b", "é", "Z", "\U0001F600", None])
        rows.append((i, " ".join(["w"] * min(3000, int(draw.lognormvariate(3, 1.2)))), source))
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_mix_meets_targets(spark):
    docs, rows = corpus(spark)
    found = mixing.mix(docs.withColumn("size", F.lit("x")).withColumn("rate", F.lit(1))).collect()
    size = {i: len(WORDS.findall(text)) for i, text, _ in rows}
    source = {i: s for i, _, s in rows}
    totals = collections.Counter()
    for i in size:
        totals[source[i]] += size[i]
    want = plain_targets(totals)
    taken = collections.Counter()
    assert sorted(r.doc_id for r in found) == sorted(size)
    for r in found:
        assert (r.size, r.source, r.source_size) == (size[r.doc_id], source[r.doc_id], totals[r.source])
        assert r.target == pytest.approx(want[r.source], rel=1e-9)
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for name, target in want.items():
        assert abs(taken[name] - target) <= 2, name
    assert sum(taken.values()) == pytest.approx(sum(totals.values()), abs=10)


def test_rates_are_those_of_the_dual(spark):
    sizes = {"a": [1, 2, 2, 3, 50, 400], "b": [5, 5, 5, 8], "c": [7, 9, 1000]}
    targets = {"a": 900.0, "b": 23.0, "c": 30.0}
    cells = [(s, size, n) for s, own in sizes.items() for size, n in collections.Counter(own).items()]
    wanted = [(s, float(sum(own)), targets[s]) for s, own in sizes.items()]
    rated = mixing.rates(
        spark.createDataFrame(cells, "source_key string, size long, rows long"),
        spark.createDataFrame(wanted, "source_key string, source_size double, target double"),
    ).collect()
    found = {(r.source_key, r.size): r.rate / mixing.UNIT for r in rated}
    for s, own in sizes.items():
        for size, rate in zip(own, plain_rates(own, targets[s])):
            assert found[s, size] == pytest.approx(rate, abs=1e-4), (s, size)


def test_reruns_agree_however_the_table_is_cut(spark):
    docs, _ = corpus(spark, 9)
    first = sorted((r.doc_id, r.copies) for r in mixing.mix(docs.repartition(7)).collect())
    assert first == sorted((r.doc_id, r.copies) for r in mixing.mix(docs.repartition(3, "source")).collect())


def test_targets_stop_at_their_most(spark):
    sizes = {"a": 10, "b": 1000, "c": 1, "d": 400, "e": 0, None: 7}
    rows = [(i, " ".join(["x"] * n), s) for i, (s, n) in enumerate(sizes.items())]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    want = plain_targets(sizes)
    assert {r.source: r.target for r in found} == pytest.approx(want)
    assert want["a"] == 30 and want[None] == 7 * 3
    for r in found:
        assert r.taken <= 3 * r.size


def test_odd_documents(spark, odd_documents, no_documents):
    found = mixing.mix(odd_documents).collect()
    assert len(found) == odd_documents.count()
    sizes = collections.Counter((r.doc_id, r.size) for r in found)
    plain = collections.Counter((r.doc_id, len(WORDS.findall(r.text or ""))) for r in odd_documents.collect())
    assert sizes == plain
    assert all(r.taken == 0 for r in found if r.size == 0)
    assert mixing.mix(no_documents).collect() == []
    words = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, text string, source string")
    assert [r.taken for r in mixing.mix(words).collect()] == [0, 0, 0]


def test_a_hot_row_that_repeats(spark):
    rows = [(1, "one two three", "a")] * 700 + [(i, "four five", "b") for i in range(700)] + [(None, "six", "b")] * 700
    found = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert collections.Counter((r.doc_id, r.size) for r in found)[1, 3] == 700 and len(found) == 2100
    taken = {s: sum(r.taken for r in found if r.source == s) for s in ("a", "b")}
    target = {r.source: r.target for r in found}
    assert all(abs(taken[s] - target[s]) <= 2 for s in taken)


def test_query(spark):
    found = QUERIES["op13_entropy_mix"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    size = {d.doc_id: len(WORDS.findall(d.text or "")) for d in docs}
    source = {d.doc_id: d.source for d in docs}
    totals, taken = collections.Counter(), collections.Counter()
    for d in docs:
        totals[d.source] += size[d.doc_id]
    want = plain_targets(totals)
    assert sorted(r.doc_id for r in found) == sorted(size)
    for r in found:
        assert (r.size, r.source_size) == (size[r.doc_id], totals[source[r.doc_id]]) and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(want[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    for name, target in want.items():
        assert abs(taken[name] - target) <= max(60, 0.02 * target)


def test_query_plan_has_no_python(spark):
    plan = QUERIES["op13_entropy_mix"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
