"""Rows of the queries without SQL, each against a plain reading of its contract."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from test_operators import lower, plain_components, plain_figures, plain_scores
from test_secret_scan import plain

import corpus_pipeline
from metaingest.llm import ngram_trie
from metaingest.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


def result(spark, name, texts):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    return rows


def test_op1(spark, texts):
    rows = result(spark, "op1_kd_shards", texts)
    shards = defaultdict(list)
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shards[r.shard].append(r)
    assert sorted(shards) == list(range(24))
    assert all(sorted(r.slot for r in part) == list(range(len(part))) for part in shards.values())
    sizes = [sum(r.size for r in part) for part in shards.values()]
    # A split can't be nearer to its median than half a document.
    assert max(sizes) - min(sizes) <= 2 * max(r.size for r in rows)


def test_op5(spark, texts):
    folds = [(i, text, zlib.crc32(str(i).encode()) % 7 == 2) for i, text in texts.items()]
    rows = {r.doc_id: r for r in result(spark, "op5_trie_scores", texts)}
    for (doc_id, _, out), (n, known, total, base, model) in zip(folds, plain_scores(folds, ngram_trie.PRIOR)):
        r = rows[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and abs(r.score - model) < 0.001 * n
    assert sum(r.score for r in rows.values() if r.held_out) > sum(r.base_score for r in rows.values() if r.held_out)


def test_op8(spark, texts):
    from tokenizers import Tokenizer

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in QUERIES["op8_packed_windows"](spark, SF_DIR).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert sorted(pieces) == sorted(texts)
    for doc_id, parts in pieces.items():
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], "<u4")
        place = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (place, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[place : place + r.length].tobytes())
            place += r.length
        assert place == len(ids)
    used = 0
    for parts in sequences.values():
        place = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 4096
        used += place
    assert used > 0.9 * 4096 * len(sequences)


def test_op9(spark, texts):
    for r in result(spark, "op9_quality_ratio", texts):
        n, *figures = plain_figures(texts[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, *figures]
        assert r.base_failed == (n < 50 or 100 * figures[-1] > 50 * n)
        assert not (r.base_failed and r.kept)


def test_op10(spark, texts):
    for r in result(spark, "op10_secret_spans", texts):
        spans = plain(texts[r.doc_id] or "")
        written = [":".join(map(str, s)) for s in spans]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(r.spans.split(","))


def test_stages_of_the_pipeline(spark, texts):
    """What stages two to four keep, from what the stage before kept, by plain rules."""
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality_rules"](spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR).cache()
    judged = {r.doc_id for r in QUERIES["op9_quality_ratio"](spark, SF_DIR).filter("kept").collect()}
    assert {r.doc_id for r in good.select("doc_id").collect()} == judged

    single = stages["near_duplicates"](spark, good, SF_DIR).cache()
    rows = [(i, texts[i]) for i in sorted(judged)]
    component = {i: found[1] for i, found in plain_components(rows, 5).items()}
    assert {r.doc_id for r in single.select("doc_id").collect()} == {i for i, least in component.items() if i == least}

    clean = stages["decontamination"](spark, single, SF_DIR).cache()
    contaminated = {r.doc_id for r in QUERIES["op3_phrase_index"](spark, SF_DIR).filter("contaminated").collect()}
    singles = {r.doc_id for r in single.select("doc_id").collect()}
    assert {r.doc_id for r in clean.select("doc_id").collect()} == singles - contaminated

    for r in stages["secret_scans"](spark, clean, SF_DIR).select("doc_id", "text").collect():
        before, last = texts[r.doc_id], 0
        for _, start, end in sorted(plain(before), key=lambda s: s[1]):
            assert before[start:end] not in r.text or start < last
            last = max(last, end)
        assert lower(before) == lower(r.text) or plain(before) or "[REDACTED]" in r.text
