"""Each operator against a plain version, and on odd and empty tables."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from metaingest.llm import near_dedup, ngram_trie, packing, phrase_index, quality, secret_scan, sharding, snapshots, url_filter, warc
from metaingest.llm import words as w
from metaingest.llm.components import components
from metaingest.llm.elias_fano import EliasFano

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
texts = st.lists(st.text(alphabet="aAbZ 09\n\t\x0b\x00é…#", max_size=20), max_size=6)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# --- words ---------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(1, 30))
def test_words_of_whole_texts(rows, limit):
    for table, rule in ((w.SPACED, SPACED), (w.ALPHANUMERIC, ALPHANUMERIC)):
        found, hashes = [], {}
        for _, _, part in w.text_slices(pa.array(rows, pa.string()), limit):
            words = w.find_words(part, table)
            spans = [bytes(part.data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
            found += [spans[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
            for word, value in zip(spans, w.hash_spans(part.data, words.starts, words.ends).tolist()):
                assert hashes.setdefault(lower(word), value) == value
        assert [[lower(x) for x in spans] for spans in found] == [rule.findall(lower(row)) for row in rows]
        assert len(set(hashes.values())) == len(hashes)


# --- 1 sharding ----------------------------------------------------------


def test_shards_have_near_equal_bytes(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.randrange(2000), rng.choice(["hot"] * 5 + ["a", "b"]), rng.randrange(9)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n long").repartition(5)
    out = sharding.shard(docs, ["n", "source"], shards=24).toPandas()
    sizes = out.groupby("shard")["size"].sum()
    assert len(out) == 3000 and len(sizes) == 24 and sizes.max() - sizes.min() < 8000
    assert all(sorted(g) == list(range(len(g))) for _, g in out.groupby("shard").slot)
    assert {r.doc_id: r.text_crc32 for r in out.itertuples()} == {r[0]: zlib.crc32(r[1].encode()) for r in rows}


def test_shards_from_target_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 92) for i in range(100)], "doc_id long, text string")
    assert sharding.shard(docs, ["doc_id"], target_bytes=2500).groupBy("shard").count().count() == 4


def test_one_repeated_row_is_split(spark):
    docs = spark.createDataFrame([(1, "same")] * 1000, "doc_id long, text string").repartition(4)
    sizes = [r["count"] for r in sharding.shard(docs, ["doc_id"], shards=4).groupBy("shard").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) == 4 and max(sizes) < 300


def test_odd_documents_in_shards(odd_documents, no_documents):
    out = sharding.shard(odd_documents, ["n_chars", "source", "score"], shards=3).collect()
    assert len(out) == odd_documents.count() and {r.shard for r in out} <= {0, 1, 2}
    assert sharding.shard(no_documents, ["n_chars"], shards=3).collect() == []


# --- 2 near-duplicates ---------------------------------------------------


def shingles(text, length):
    words = SPACED.findall(lower(text))
    if len(words) < length:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + length]) for i in range(len(words) - length + 1)}


def plain_components(rows, length):
    sets = {i: shingles(t, length) for i, t in rows}
    label = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    return {i: (len(sets[i]), label[i]) for i in sets}


@pytest.mark.parametrize("length", [2, 5])
def test_near_duplicates(spark, length):
    rng = random.Random(length)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(150):
        words = list(base) if i % 3 else [f"v{rng.randrange(50)}" for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(8)):
            if words:
                words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, length).collect()}
    assert got == plain_components(rows, length)


def test_odd_near_duplicates(odd_documents, no_documents):
    out = near_dedup.near_duplicates(odd_documents, 2)
    found = collections.Counter((r.doc_id, r.component_id) for r in out.collect())
    alone = [(i, i) for i in (3, 4, 5, 8)]
    assert found == collections.Counter([(1, 1), (1, 1), (2, 1), (None, 1), (6, 6), (7, 6), (9, 1), (None, None), *alone])
    kept = near_dedup.keep_one(odd_documents, 2)
    assert kept.columns == odd_documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 1, 3, 4, 5, 6, 8]
    assert near_dedup.near_duplicates(no_documents).collect() == [] and near_dedup.keep_one(no_documents).collect() == []


def test_one_row_of_a_component_stays(spark):
    x, y, z, u = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyzu")
    rows = [(5, x), (5, y), (3, x), (None, x), (None, y), (None, z), (None, z), (None, z + " end"), (7, u), (7, u + " end"), (8, u)]
    rows += [(None, None), (None, None), (None, " "), (4, ""), (4, "")]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    found = collections.Counter((r.doc_id, r.text) for r in kept.collect())
    assert [n for (_, text), n in found.items() if text and text.startswith("z")] == [1]
    assert [(i, n) for (i, text), n in found.items() if text and text.startswith("u")] == [(7, 1)]
    rest = {key: n for key, n in found.items() if not (key[1] or "").startswith(("z", "u"))}
    assert rest == {(3, x): 1, (5, y): 1, (None, None): 2, (None, " "): 1, (4, ""): 2}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(7, 7), (None, 3), (5, 4)]
    out = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r.node: r.component for r in out} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}
    assert len(out) == 71


# --- 3 phrase index ------------------------------------------------------


def test_contamination(spark):
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(6)]
    item = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 13, 20, 1, 0])] + [(9, None), (None, "t0 t1 t0")]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(60)] + [(99, None), (98, item[2][1])]
    out = phrase_index.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(item, "item_id long, text string")
    )
    for row in out.collect():
        words = ALPHANUMERIC.findall(lower(dict(docs)[row.doc_id]))
        hit, items = set(), set()
        for key, text in item:
            terms = ALPHANUMERIC.findall(lower(text))
            for start in range(max(len(terms) - 12, 1)) if terms else ():
                window = terms[start : start + 13]
                for at in range(len(words) - len(window) + 1):
                    if words[at : at + len(window)] == window:
                        hit.update(range(at, at + len(window)))
                        items.add(key)
        assert (row.n_words, row.n_hit, set(row["items"])) == (len(words), len(hit), items - {None})
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_proximity_and_small_blocks(spark):
    docs = spark.createDataFrame([(1, "a x b x x c"), (2, "c b a"), (3, "a b"), (4, "a b x x x x c"), (5, "a"), (6, "b c")], "doc_id long, text string")
    queries = phrase_index.windows_of(spark.createDataFrame([(1, "a b c"), (2, "b"), (3, "zz a")], "item_id long, text string"))
    index = phrase_index.build_index(docs)
    for block in (1, 100):
        out = {r.doc_id: sorted(r["items"]) for r in phrase_index.search(index, queries, within=6, block=block).collect()}
        assert out == {1: [1, 2], 2: [1, 2], 3: [2], 4: [2], 5: [], 6: [2]}
    assert {r.doc_id for r in phrase_index.search(index, queries).collect() if r["items"]} == {1, 2, 3, 4, 6}


def test_odd_documents_in_the_index(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "word3 WORD4 word5"), (2, None)], "item_id long, text string")
    kept = phrase_index.without_contaminated(odd_documents, items)
    assert kept.columns == odd_documents.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter([3, 4, 5, 6, 7, 8, None])
    assert phrase_index.without_contaminated(odd_documents, items.limit(0)).count() == odd_documents.count()
    assert phrase_index.contamination(no_documents, items).collect() == []


# --- 4 chats -------------------------------------------------------------


def test_snapshots(spark):
    full = [("user", "a"), ("assistant", "b"), ("user", None), ("assistant", "d <|im_start|>")]
    rows = [(i, t, *full[t]) for i in (1, 2, 3, 4) for t in range(i)] + [(9, t, *full[t]) for t in range(4)] + [(4, 0, *full[0])]
    rows += [(5, 0, "user", "a"), (5, 1, "assistant", "other"), (None, 0, "user", "x"), (6, None, None, None)]
    chats = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, h1 int")
    out = {r.conv_id: (r.n_turns, r.text) for r in snapshots.render(chats).collect()}
    turn = "<|im_start|>{}\n{}<|im_end|>\n".format
    assert out == {
        4: (4, turn("user", "a") + turn("assistant", "b") + turn("user", "") + turn("assistant", "d <| im_start|>")),
        5: (2, turn("user", "a") + turn("assistant", "other")),
        6: (1, turn("", "")),
    }
    assert snapshots.render(chats.limit(0)).collect() == []


def test_turns_of_one_number_go_by_role_and_text(spark):
    long = "r" * 40
    said = [(None, "b"), ("user", None), ("user", "b"), ("user", "a"), ("user", "x" * 50 + "b"), ("user", "x" * 50 + "a"), ("a", "z")]
    said += [(long + "b", "a"), (long + "a", "b"), ("r" * 32, "zz")]
    order = sorted(said, key=lambda s: tuple((x is None, x or "") for x in s))
    rows = [(1, 5, *s) for s in said * 2] + [(1, 6, "user", "end")] + [(2, 5, *s) for s in order[:7]] + [(3, 5, *s) for s in order[1:]]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    out = {r.conv_id: (r.n_turns, r.text) for r in snapshots.render(chats).collect()}
    turn = "<|im_start|>{}\n{}<|im_end|>\n".format
    whole, tail = [*order, ("user", "end")], order[1:]
    assert out == {k: (len(x), "".join(turn(r or "", t or "") for r, t in x)) for k, x in ((1, whole), (3, tail))}


def test_a_conversation_over_many_tasks(spark):
    rows = [(1, t, "user", str(t % 7)) for t in range(500)] + [(2, t, "user", str(t % 7)) for t in range(300)] + [(3, 0, "user", "1")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    assert sorted(tuple(r) for r in snapshots.maximal(chats).collect()) == [(1, 500), (3, 1)]


# --- 5 language model ----------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(5001, 1 << 50))
def test_elias_fano(values, universe):
    values = np.array(sorted(values), np.uint64)
    coded = EliasFano.encode(values, universe)
    assert (coded[np.arange(len(values))] == values).all()
    wanted = np.arange(0, 5001, 7, dtype=np.uint64)
    at = coded.successor(wanted, np.zeros(len(wanted), np.int64), np.full(len(wanted), len(values)))
    assert (at == np.searchsorted(values, wanted)).all()


def plain_scores(rows, prior):
    tokens = [(SPACED.findall(lower(t)) + ["</s>"], out) for _, t, out in rows]
    one, two, begins = collections.Counter(), collections.Counter(), 0
    for words, out in tokens:
        if not out:
            one.update(words)
            two.update(zip(["<s>", *words], words))
            begins += 1
    one["<s>"] = 0
    total, size = sum(one.values()), len(one) - 1
    scores = []
    for words, _ in tokens:
        base = [(one[x] + 1) / (total + size + 1) for x in words]
        before = [begins, *(one[x] for x in words)]
        model = [(two[v, x] + prior * p) / (c + prior) for v, x, p, c in zip(["<s>", *words], words, base, before)]
        scores.append((len(words), sum(one[x] > 0 for x in words), total, sum(map(math.log10, base)), sum(map(math.log10, model))))
    return scores


@pytest.mark.parametrize("hot", [10**9, 20])
def test_trie_scores(spark, monkeypatch, hot):
    monkeypatch.setattr(ngram_trie, "HOT_TOKENS", hot)
    monkeypatch.setattr(ngram_trie, "PART_TOKENS", 100)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("aabcdeFGHij") for _ in range(rng.randrange(30))), i % 4 == 0) for i in range(80)] + [(99, None, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, out boolean").repartition(3)
    got = {r.doc_id: r for r in ngram_trie.score(docs, F.col("out")).collect()}
    for (key, _, out), (n, known, total, base, model) in zip(rows, plain_scores(rows, ngram_trie.PRIOR)):
        row = got[key]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (out, n, known, total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and abs(row.score - model) < 0.001 * n


@pytest.mark.parametrize("out", [lambda i: i % 4 == 0, lambda i: i % 9 != 0, lambda i: True])
def test_a_hot_bigram_is_split(spark, monkeypatch, out):
    monkeypatch.setattr(ngram_trie, "HOT_TOKENS", 100)
    monkeypatch.setattr(ngram_trie, "PART_TOKENS", 200)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("aabcdefghijklmnop") for _ in range(4)) + " so so so", out(i)) for i in range(900)] + [(999, "only " * 5000, True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, out boolean").repartition(24)
    got = {r.doc_id: r for r in ngram_trie.score(docs, F.col("out")).collect()}
    for (key, _, held), (n, known, total, base, model) in zip(rows, plain_scores(rows, ngram_trie.PRIOR)):
        row = got[key]
        assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (held, n, known, total)
        assert math.isclose(row.base_score, base, rel_tol=1e-9) and abs(row.score - model) < 0.001 * n

    marked = docs.select("doc_id", "text", F.col("out").alias("held_out"))
    corpus = ngram_trie.count_corpus(marked)
    kinds = "part long, batch long, doc_ids array<long>, train binary, sizes binary, words binary, counts binary, contexts binary, places binary, times binary"
    dealt = marked.mapInArrow(ngram_trie._deal(corpus), kinds).filter("part >= 0")
    entries = dealt.groupBy("part").agg(F.sum(F.octet_length("contexts") / 5).alias("n")).collect()
    assert len(entries) > 30 and max(r.n for r in entries) < 700  # 'so so' alone is in 900 texts
    assert sum(x.parts for x in corpus.hot_pairs.values()) > 18 and sum(r.n for r in entries) < 7300


def test_odd_documents_are_scored(odd_documents, no_documents):
    out = ngram_trie.score(odd_documents, ngram_trie.held_out(F.col("doc_id"))).collect()
    assert len(out) == odd_documents.count() and all(r.score < 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (3, 4, 5)} == {1}
    assert all(r.n_known == 0 for r in ngram_trie.score(odd_documents, F.lit(True)).collect())
    assert ngram_trie.score(no_documents, F.lit(False)).collect() == []


# --- 6 WARC --------------------------------------------------------------


def archive(blocks):
    out = b""
    for i, block in enumerate(blocks):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(block)}\r\n"
        digest = __import__("hashlib").sha256(block).hexdigest()
        out += head.encode() + f"WARC-Block-Digest: sha256:{digest}\r\n\r\n".encode() + block + b"\r\n\r\n"
    return out


def test_pages_come_back(spark, tmp_path):
    long = "é" * 60
    rows = [(3, "u\r\nX: y", long), (1, "u", long), (2, None, long), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", "WARC/1.1\r\n\r\n\r\n")]
    rows += [(None, "u", long), (8, "u", "y" * 100_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    path = str(tmp_path / "out")
    warc.write_archives(warc.plan_records(pages), path, warc.average_record(pages))
    records, gaps = warc.read_archives(spark, path)
    assert gaps.collect() == []
    got = collections.Counter(
        (r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.payload_figures(records).collect()
    )
    uri = "<urn:page:{}>".format
    want = [(uri(i), "revisit", uri(1), 120) for i in (2, 3)] + [(None, "revisit", uri(1), 120), (uri(1), "response", None, 120)]
    want += [(uri(i), "response", None, n) for i, n in ((4, 5), (5, 5), (6, 0), (7, 14), (8, 100_000))]
    assert got == collections.Counter(want)


def test_no_pages(spark, tmp_path):
    path = str(tmp_path / "out")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(warc.plan_records(pages), path, warc.average_record(pages))
    records, gaps = warc.read_archives(spark, path)
    assert records.collect() == gaps.collect() == []


@pytest.mark.parametrize("packed", [False, True])
def test_salvage(packed):
    import gzip

    parts = [archive([f"block {i} ".encode() * 20]) for i in range(5)]
    parts = [gzip.compress(p) if packed else p for p in parts]
    whole = b"".join(parts)

    def read(data):
        found = list(warc.salvage(data))
        gaps = [x for x in found if isinstance(x, warc.Gap)]
        return [x[2][:7].decode() for x in found if not isinstance(x, warc.Gap)], [(g.start, g.end) for g in gaps]

    ends = np.cumsum([len(p) for p in parts]).tolist()
    assert read(whole) == ([f"block {i}" for i in range(5)], [])
    broken = bytearray(whole)
    broken[ends[1] + len(parts[2]) // 2] ^= 0x55
    assert read(bytes(broken)) == ([f"block {i}" for i in (0, 1, 3, 4)], [(ends[1], ends[2])])
    assert read(whole[: ends[3] + 20])[0] == [f"block {i}" for i in range(4)]
    assert read(b"junk" + whole) == ([f"block {i}" for i in range(5)], [(0, 4)])
    assert read(whole[: ends[1]] + b"\x1f\x8b\x08WARC/1.1\r\n" + whole[ends[1] :])[0] == [f"block {i}" for i in range(5)]
    assert read(b"nothing here") == ([], [(0, 12)]) and read(b"") == ([], [])


def members(data):
    found = list(warc.salvage(data))
    gaps = [(g.member, g.start, g.end) for g in found if isinstance(g, warc.Gap)]
    return [(x[0], x[2][:8].decode()) for x in found if not isinstance(x, warc.Gap)], gaps


@pytest.mark.parametrize("level", [0, 6])
def test_salvage_inside_members(level):
    import gzip

    rng = random.Random(6)
    parts = [archive([f"block {i} ".encode() + rng.randbytes(3000)]) for i in range(60)]
    names, ends = [f"block {i} "[:8] for i in range(60)], np.cumsum([len(p) for p in parts]).tolist()
    whole = b"".join(parts)
    assert members(gzip.compress(whole, level)) == ([(0, n) for n in names], [])

    # a wrong record, in a member that is whole
    wrong = bytearray(whole)
    wrong[ends[29] + len(parts[30]) // 2] ^= 0x55
    packed = gzip.compress(bytes(wrong), level)
    again = gzip.compress(whole, level)
    first = [(0, n) for i, n in enumerate(names) if i != 30]
    assert members(packed) == (first, [(0, ends[29], ends[30])])
    assert members(packed + again) == (first + [(len(packed), n) for n in names], [(0, ends[29], ends[30])])

    # a member cut short, alone and before a whole one
    cut = again[: len(again) * 2 // 3]
    found, gaps = members(cut)
    assert 38 <= len(found) <= 40 and found == [(0, n) for n in names[: len(found)]] and gaps == [(None, 0, len(cut))]
    found, gaps = members(cut + again)
    assert found[-60:] == [(len(cut), n) for n in names] and 38 <= len(found) - 60 <= 40 and gaps == [(None, 0, len(cut))]

    # a wrong check sum loses no record; no record comes twice
    trailer = bytearray(again)
    trailer[-6] ^= 1
    assert members(bytes(trailer)) == ([(0, n) for n in names], [(None, 0, len(again))])


def test_salvage_of_members_that_break():
    import gzip

    text = " ".join(f"w{i % 9973}" for i in range(60_000))
    blocks = [f"block {i} {text[i * 3000 : i * 3000 + 3000]}".encode() for i in range(60)]
    good = gzip.compress(archive(blocks))
    broken = bytearray(good)
    broken[len(good) // 2 : len(good) // 2 + 40] = bytes(40)
    found, gaps = members(bytes(broken) + bytes(broken) + good)
    starts = [0, len(good), 2 * len(good)]
    by_member = [[n for at, n in found if at == start] for start in starts]
    names = [b[:8].decode() for b in blocks]
    assert by_member[2] == names and by_member[0] == by_member[1] and len(found) == sum(map(len, by_member))
    assert 20 <= len(by_member[0]) < 60 and set(by_member[0]) <= set(names) and by_member[0][:20] == names[:20]
    assert [g[1:] for g in gaps if g[0] is None] == [(0, len(good)), (len(good), 2 * len(good))]


def test_gaps_of_archives(spark, tmp_path):
    import gzip

    wrong = archive([b"one", b"two", b"three"]).replace(b"two", b"TWO")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(wrong))
    records, gaps = warc.read_archives(spark, str(tmp_path))
    assert sorted(bytes(r.block) for r in records.collect()) == [b"one", b"three"]
    [gap] = gaps.collect()
    assert (gap.member, gap.reason) == (0, "wrong digest") and wrong[gap.start : gap.end].count(b"TWO") == 1


def test_the_query_fails_at_a_gap(spark, monkeypatch):
    from metaingest.llm import queries

    monkeypatch.setattr(queries.warc, "write_archives", _write_damaged(warc.write_archives))
    with pytest.raises(ValueError, match="damaged"):
        queries.QUERIES["op6_warc_salvage"](spark, "/root/testdata/sf0.001")


def _write_damaged(write):
    def damaged(records, path, *rest):
        write(records, path, *rest)
        with open(path.removeprefix("file:") + "/damaged.txt", "wb") as file:
            file.write(b"WARC/1.1\r\n")

    return damaged


# --- 7 urls --------------------------------------------------------------


def test_urls(spark):
    rows = [(i, f"http://h{i % 900}.example.com/x") for i in range(1500)] + [(2000, None), (2001, "no scheme"), (2002, "A://B.Org"), (2003, "x://B.oRg/?q")]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, verdict string")
    listed = F.col("host").rlike("^h[0-9]*7[.]")
    for keys in (url_filter.MAX_KEYS, 100):
        out = {r.page_id: r for r in url_filter.judge_urls(pages, listed, [url_filter.Rule("allow", "org", "/")], max_keys=keys).collect()}
        assert all((out[i].verdict == "block") == (i % 900 % 10 == 7) for i in range(1500))
        assert [(out[i].host, out[i].path, out[i].rule) for i in (2000, 2001, 2002, 2003)] == [("", "", None)] * 2 + [("b.org", "", None), ("b.org", "/", "org/")]
    assert url_filter.judge_urls(pages.limit(0), listed, []).collect() == []


def test_longest_rule(spark):
    rules = [url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "a.org", "/x"), url_filter.Rule("allow", "a.org", "/xy")]
    rows = spark.createDataFrame([("a.org", "/xyz"), ("b.a.org", "/x"), ("ba.org", "/x"), ("org", "/"), ("com", "/")], "host string, path string")
    out = rows.select(*url_filter.longest_rule(F.col("host"), F.col("path"), rules)).collect()
    assert [tuple(r) for r in out] == [("a.org/xy", "allow"), ("a.org/x", "block"), ("org/", "allow"), ("org/", "allow"), (None, None)]


# --- 8 packing -----------------------------------------------------------


@pytest.fixture(scope="session")
def vocabulary():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbZ 09\n\x0b\x85é…#'<>|́ß한≠", max_size=20), max_size=4))
def test_word_ids_are_the_tokenizers(vocabulary, rows):
    from tokenizers import Tokenizer

    rows = [*rows, "it's <|endoftext|>x", "<|ENDOFTEXT|> don't 'll3"]
    whole = Tokenizer.from_file(vocabulary)
    got = packing.WordTokenizer(vocabulary).ids(w.arrow_texts(pa.array(rows)))
    assert [x.tolist() for x in got] == [whole.encode(t, add_special_tokens=False).ids for t in rows]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60), st.integers(1, 12))
def test_differencing_parts_everything(sizes, windows):
    parts = packing.difference(sizes, windows)
    assert len(parts) == windows and sorted(i for p in parts for i in p) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in p) <= 50 for p in packing.windows_of(sizes, 50))


def test_packed_documents(spark, odd_documents, no_documents, vocabulary):
    out = packing.pack(odd_documents, vocabulary, capacity=256).toPandas()
    assert (out.groupby("sequence_id").length.sum() <= 256).all()
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == (part.length.cumsum() - part.length).tolist()
    assert out[out.doc_id.isin([3, 4, 5])].doc_tokens.tolist() == [1, 1, 1]
    for _, part in out[out.doc_id.isin([2, 6, 8])].sort_values("start").groupby("doc_id"):
        assert part.start.tolist() == (part.length.cumsum() - part.length).tolist() and part.length.sum() == part.doc_tokens.iloc[0]
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out.itertuples())
    assert packing.pack(no_documents, vocabulary).collect() == []


# --- 9 quality -----------------------------------------------------------


def plain_figures(text):
    text = text or ""
    words = SPACED.findall(text)
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again)


def test_quality_figures(spark):
    rng = random.Random(9)
    rows = [(i, "".join(rng.choice(["a ", "b ", "é# ", "\n", "A ", "\n\n"]) for _ in range(rng.randrange(80)))) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    out = quality.judge(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    for r in out.collect():
        n, *rest = plain_figures(dict(rows)[r.doc_id])
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == [n, *rest]
        assert r.base_failed == (n < 50 or 100 * rest[-1] > 50 * n) and r.kept == (not r.base_failed and r.score >= quality.THRESHOLD)


def test_quality_tells_trusted_from_raw(spark):
    rng = random.Random(10)
    good = [(i, " ".join(f"good{rng.randrange(400)}" for _ in range(200))) for i in range(60)]
    bad = [(100 + i, " ".join(f"junk{rng.randrange(400)}" for _ in range(200))) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(30), *range(100, 110)]], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(spark.createDataFrame(good + bad, "doc_id long, text string"), labels)
    assert {r.doc_id for r in kept.collect()} == set(range(60))


def test_quality_keeps_clean_texts_with_many_copies(spark):
    rng = random.Random(11)
    words = [[f"good{rng.randrange(400)}" for _ in range(200)] for _ in range(61)]
    rows = [(i, " ".join(x)) for i, x in enumerate(words[:60])] + [(1000 + i, " ".join(words[60])) for i in range(500)]
    for i in range(500):
        near = list(words[60])
        near[rng.randrange(200)] = f"good{rng.randrange(400)}"
        rows.append((2000 + i, " ".join(near)))
    rows += [(100 + i, " ".join(f"junk{rng.randrange(400)}" for _ in range(200))) for i in range(20)]
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(30), *range(100, 110)]], "doc_id long, quality int, toxic int")
    kept = quality.keep_good(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if not 100 <= i < 120}


def test_quality_of_odd_documents(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (8, None)], "doc_id long, quality int")
    kept = quality.keep_good(odd_documents, labels)
    assert kept.columns == odd_documents.columns and {(r.n_words, r.score, r.kept) for r in kept.collect()} == {(0, 0.5, True)}
    assert quality.judge(odd_documents, labels.limit(0)).filter("score <> 0").count() == 0
    assert quality.keep_good(no_documents, labels).collect() == []


# --- 10 secrets ----------------------------------------------------------


def test_secrets_of_odd_documents(odd_documents):
    out = secret_scan.find_secrets(odd_documents)
    assert out.count() == odd_documents.count() and out.filter(F.size("spans") > 0).count() == 0
    assert secret_scan.redact(odd_documents).exceptAll(odd_documents).count() == 0
