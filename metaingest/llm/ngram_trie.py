"""Language-model scoring by Elias-Fano n-gram tries.

The model is a bigram model with a Dirichlet prior on the add-one unigram:

    P(w | v) = (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR),  P(w) = (c(w) + 1) / (N + V + 1)

It is one distributed trie. Its parts are dealt by the predicted word w: a part
has the words in order, a monotone pointer from each to its contexts, and the
contexts v seen before it, again in order. Pointers and contexts are Elias-Fano
sequences, and each entry has its smoothed probability's logarithm in 16 bits.
The levels lie in one memory-mapped file. A query looks for the successor of its
context among those of its word.

No level is collected or broadcast. All occurrences, of training and other
texts, are dealt once to the part of their word, in packed blocks; there the
training ones build the trie, all of them query it, and sums for each text come
back. A bigram that a text repeats is dealt once with its number. A word with more
than ``HOT_TOKENS`` occurrences is dealt by word and context, and a bigram with
more than these is dealt over several parts. Their training counts go to all parts;
hot words and hot bigrams number at most N / HOT_TOKENS each. The number of parts
grows with the corpus.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as w
from .elias_fano import EliasFano

#: Weight of the unigram probability against counts after a context.
PRIOR = 300.0
PART_TOKENS = 4_000_000
HOT_TOKENS = 2_000_000
BATCH_TOKENS = 3_000_000
_CONTEXT_BITS = 40
_END = np.uint64(0x2545F4914F6CDD1D)
_BEGIN = np.uint64(0x14057B7EF767814F)
#: Log10 probabilities and weights lie between these.
_LOWEST, _HIGHEST = -25.0, 20.0


def quantised(logs: np.ndarray) -> np.ndarray:
    return np.round((logs - _LOWEST) / (_HIGHEST - _LOWEST) * 65535).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes * ((_HIGHEST - _LOWEST) / 65535) + _LOWEST


class Trie:
    """One part: words, their contexts, and quantised logarithms."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, keys: np.ndarray, together: np.ndarray, unigram: np.ndarray, prior: float):
        """``keys``: ascending, a word's number in ``words`` above the context's
        bits; ``together``: how often they occur; ``unigram``: P of each word."""
        of = (keys >> np.uint64(_CONTEXT_BITS)).astype(np.int64)
        pointers = np.searchsorted(of, np.arange(len(words) + 1)).astype(np.uint64)
        levels = EliasFano.encode(pointers, len(keys) + 1), EliasFano.encode(keys, max(1, len(words)) << _CONTEXT_BITS)
        alone = quantised(np.log10(prior * unigram))
        weight = quantised(np.log10(counts + prior))
        seen = quantised(np.log10(together + prior * unigram[of]))
        stored = [*levels[0].parts(), *levels[1].parts(), alone, weight, seen]
        mapped = _mapped(stored)
        self.pointers = EliasFano(levels[0].count, levels[0].width, *mapped[:3])
        self.contexts = EliasFano(levels[1].count, levels[1].width, *mapped[3:6])
        self.alone, self.weight, self.seen = mapped[6:]

    def numerators(self, keys: np.ndarray) -> np.ndarray:
        """Log10 of the numerator of P for each key."""
        of = (keys >> np.uint64(_CONTEXT_BITS)).astype(np.int64)
        low, high = self.pointers[of].astype(np.int64), self.pointers[of + 1].astype(np.int64)
        at = self.contexts.successor(keys, low, high)
        found = np.flatnonzero(at < high)
        found = found[self.contexts[at[found]] == keys[found]]
        codes = self.alone[of]
        codes[found] = self.seen[at[found]]
        return restored(codes)

    def denominators(self) -> np.ndarray:
        """Log10 of the denominator of P after each word."""
        return restored(self.weight)


def _mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays as views of one memory-mapped file that goes with them."""
    with tempfile.TemporaryFile() as file:
        for array in arrays:
            file.write(array.tobytes())
            file.write(bytes(-array.nbytes % 8))
        file.flush()
        whole = np.memmap(file, np.uint8, "r") if file.tell() else np.zeros(0, np.uint8)
    out, at = [], 0
    for array in arrays:
        out.append(whole[at : at + array.nbytes].view(array.dtype))
        at += array.nbytes + -array.nbytes % 8
    return out


class Hot(NamedTuple):
    """Training occurrences of a hot word or bigram, and parts that hold them all."""

    train: int
    parts: int


class Corpus(NamedTuple):
    """Totals of the training tokens, the number of parts, and the counts of hot
    words and of hot bigrams: word and ``_short`` context."""

    tokens: int
    words: int
    texts: int
    parts: int
    hot: dict[int, Hot]
    hot_pairs: dict[tuple[int, int], Hot]


def held_out(doc_id: Column) -> Column:
    """Ids whose CRC as text leaves 2 modulo 7; a null id is text of no length."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 7 == 2


def _tokens(texts: w.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and where texts begin."""
    words = w.find_words(texts)
    hashes = w.hash_spans(texts.data, words.starts, words.ends)
    return np.insert(hashes, words.first[1:], _END), words.first + np.arange(len(words.first))


def _short(contexts: np.ndarray) -> np.ndarray:
    return contexts >> np.uint64(64 - _CONTEXT_BITS)


def _contexts(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The token before each; ``first`` are the places where texts begin."""
    contexts = np.concatenate((tokens[-1:], tokens[:-1]))
    contexts[first] = _BEGIN
    return contexts


def _counts(docs: DataFrame, hot: np.ndarray | None = None) -> DataFrame:
    """``times`` (training) and ``occurrences`` (all) of each word or, given
    ascending ``hot`` words, of each bigram of these: its ``key`` has their
    numbers, the word's times ``len(hot)`` plus the context's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.uint64), np.zeros((2, 0), np.int64)
        for batch in batches:
            train = ~batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for low, high, texts in w.text_slices(batch.column("text"), 4 << 20):
                tokens, first = _tokens(texts)
                learnt = np.repeat(train[low:high], np.diff(first))
                if hot is not None:
                    pairs = np.stack((tokens, _contexts(tokens, first[:-1])))
                    at = np.minimum(np.searchsorted(hot, pairs), len(hot) - 1)
                    both = (hot[at] == pairs).all(0)
                    tokens, learnt = (at[0] * len(hot) + at[1])[both].astype(np.uint64), learnt[both]
                found, back = np.unique(tokens, return_inverse=True)
                more = np.bincount(back[learnt], minlength=len(found)), np.bincount(back, minlength=len(found))
                keys, back = np.unique(np.concatenate((keys, found)), return_inverse=True)
                sums = np.stack([np.bincount(back, np.concatenate(x), len(keys)).astype(np.int64) for x in zip(sums, more)])
                if len(keys) > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], names)
                    keys, sums = keys[:0], sums[:, :0]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *map(pa.array, sums)], names)

    names = ["key", "times", "occurrences"]
    counted = docs.select("text", "held_out").mapInArrow(count, "key long, times long, occurrences long")
    return counted.groupBy("key").agg(F.sum("times").alias("times"), F.sum("occurrences").alias("occurrences"))


def count_corpus(docs: DataFrame) -> Corpus:
    """Counts all tokens; a second pass counts bigrams if there are hot words."""
    hot = F.collect_list(F.when(F.col("occurrences") > HOT_TOKENS, F.struct("key", "times", "occurrences")))
    end = F.max(F.when(F.col("key") == int(_END.view(np.int64)), F.col("times")))
    totals = F.sum("times").alias("tokens"), F.count_if(F.col("times") > 0).alias("words"), F.sum("occurrences").alias("all")
    found = _counts(docs).agg(*totals, end.alias("texts"), hot.alias("hot")).first()

    def counts_of(row) -> Hot:
        return Hot(row.times, -(-row.occurrences // HOT_TOKENS))

    words = {row.key & (1 << 64) - 1: counts_of(row) for row in found.hot}
    pairs = {}
    if words:
        # A hot bigram has two hot words, or begins a text.
        both = np.unique(np.array([*words, int(_BEGIN)], np.uint64))
        short = _short(both).tolist()
        for row in _counts(docs, both).filter(F.col("occurrences") > HOT_TOKENS).collect():
            word, context = divmod(row.key, len(both))
            pairs[int(both[word]), short[context]] = counts_of(row)
    parts = max(1, -(-(found["all"] or 0) // PART_TOKENS))
    return Corpus(found.tokens or 0, found.words, found.texts or 0, parts, words, pairs)


def _part_of(hashes: np.ndarray, contexts: np.ndarray, corpus: Corpus, number: int) -> np.ndarray:
    """The part of each bigram of batch ``number``; batches take turns at the parts of a hot one."""
    key = hashes.copy()
    if corpus.hot:
        hot = np.isin(hashes, np.fromiter(corpus.hot, np.uint64))
        key[hot] = w.mix(hashes[hot] + contexts[hot])
    part = (w.mix(key) % np.uint64(corpus.parts)).astype(np.int64)
    turn = (number >> 33) + (number & (1 << 33) - 1)
    for (word, context), found in corpus.hot_pairs.items():
        mine = (hashes == np.uint64(word)) & (_short(contexts) == np.uint64(context))
        part[mine] = (part[mine] + turn % found.parts) % corpus.parts
    return part


_DEALT = ["part", "batch", "doc_ids", "train", "sizes", "words", "counts", "contexts", "places", "times"]


def _deal(corpus: Corpus):
    limit = BATCH_TOKENS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple] = []
        size = 0
        for batch in batches:
            out = batch.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for low, high, texts in w.text_slices(batch.column("text")):
                tokens, first = _tokens(texts)
                held.append((batch.column("doc_id").slice(low, high - low), ~out[low:high], tokens, first))
                size += len(tokens)
                if size >= limit:
                    yield from _dealt(number, held, corpus)
                    held, size, number = [], 0, number + 1
        if held:
            yield from _dealt(number, held, corpus)

    return deal


def _dealt(number: int, held: list[tuple], corpus: Corpus) -> Iterator[pa.RecordBatch]:
    """One row with the texts of a batch, and one for each part with tokens."""
    ids = pa.concat_arrays([x[0] for x in held])
    train = np.concatenate([x[1] for x in held])
    sizes = np.concatenate([np.diff(x[3]) for x in held])
    tokens = np.concatenate([x[2] for x in held])
    first = np.cumsum(sizes) - sizes
    contexts = _contexts(tokens, first)
    places = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
    same = w.mix(w.mix(tokens + w.mix(contexts)) + places)  # one hash for a text's bigram
    _, once, times = np.unique(same, return_index=True, return_counts=True)
    order = np.argsort(once)
    once, times = once[order], times[order].astype(np.uint32)
    tokens, contexts, places = tokens[once], contexts[once], places[once]
    flags, empty = np.packbits(train).tobytes(), pa.nulls(1, pa.list_(ids.type))

    def row(part: int, doc_ids: pa.Array, *blobs: bytes | None) -> pa.RecordBatch:
        columns = [pa.array([part], pa.int64()), pa.array([number], pa.int64()), doc_ids, pa.array([flags], pa.binary())]
        return pa.RecordBatch.from_arrays([*columns, *(pa.array([b], pa.binary()) for b in blobs)], _DEALT)

    texts = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    yield row(-1 - number, texts, sizes.astype(np.int64).tobytes(), None, None, None, None, None)
    part = _part_of(tokens, contexts, corpus, number)
    order = np.lexsort((tokens, part))  # texts stay in order within a word
    borders = np.searchsorted(part[order], np.arange(corpus.parts + 1))
    pack = zstandard.ZstdCompressor(level=1).compress
    for k, (low, high) in enumerate(zip(borders[:-1], borders[1:])):
        if low < high:
            mine = order[low:high]
            of = tokens[mine]
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            short = _short(contexts[mine]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, : _CONTEXT_BITS // 8]
            steps = np.diff(places[mine], prepend=np.uint32(0)).astype(np.uint32)
            split = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T)  # equal bytes lie together
            counts = np.diff(np.append(starts, len(of))).astype(np.uint32)
            yield row(k, empty, None, of[starts].tobytes(), pack(counts.tobytes()), short.tobytes(), pack(split.tobytes()), pack(times[mine].tobytes()))


_SUMS = ["batch", "doc_ids", "train", "sizes", "places", "known", "base", "score"]


def _query(corpus: Corpus, prior: float):
    def query(rows: pa.Table) -> pa.Table:
        if rows["part"][0].as_py() < 0:  # texts of batches
            nothing = pa.nulls(len(rows), pa.binary())
            return pa.table([rows["batch"], rows["doc_ids"], rows["train"], rows["sizes"], nothing, nothing, nothing, nothing], names=_SUMS)
        unpack = zstandard.ZstdDecompressor().decompress
        blobs = [np.frombuffer(b, np.uint64) for b in rows["words"].to_pylist()]
        repeats = [np.frombuffer(unpack(b), np.uint32) for b in rows["counts"].to_pylist()]
        words = np.unique(np.concatenate(blobs))
        of = np.concatenate([np.repeat(np.searchsorted(words, b), r) for b, r in zip(blobs, repeats)])
        lengths = [int(r.sum()) for r in repeats]
        short = np.zeros((len(of), 8), np.uint8)
        short[:, : _CONTEXT_BITS // 8] = np.frombuffer(b"".join(rows["contexts"].to_pylist()), np.uint8).reshape(len(of), -1)
        keys = short.view("<u8").ravel() | (of.astype(np.uint64) << np.uint64(_CONTEXT_BITS))
        del short
        places, train = [], []
        for flags, blob in zip(rows["train"].to_pylist(), rows["places"].to_pylist()):
            steps = np.frombuffer(unpack(blob), np.uint8).reshape(4, -1).T
            places.append(np.cumsum(np.ascontiguousarray(steps).view(np.uint32).ravel(), dtype=np.uint32))
            train.append(np.unpackbits(np.frombuffer(flags, np.uint8)).astype(bool)[places[-1]])
        learnt = np.concatenate(train)
        times = np.concatenate([np.frombuffer(unpack(b), np.uint32) for b in rows["times"].to_pylist()])
        counts = np.bincount(of[learnt], times[learnt], len(words)).astype(np.int64)
        place_of = {}
        for word, count in corpus.hot.items():
            at = int(np.searchsorted(words, np.uint64(word)))
            if at < len(words) and words[at] == np.uint64(word):
                counts[at], place_of[word] = count.train, at
        whole = {place_of[word] << _CONTEXT_BITS | context: n.train for (word, context), n in corpus.hot_pairs.items() if n.train and word in place_of}
        hot_keys = np.array(sorted(whole), np.uint64)
        nodes, back = np.unique(np.concatenate((keys[learnt], hot_keys)), return_inverse=True)
        together = np.bincount(back[: len(back) - len(hot_keys)], times[learnt], len(nodes)).astype(np.int64)
        together[back[len(back) - len(hot_keys) :]] = [whole[key] for key in sorted(whole)]
        del back
        trie = Trie(words, counts, nodes, together, (counts + 1) / (corpus.tokens + corpus.words + 1), prior)
        distinct, back = np.unique(keys, return_inverse=True)
        score = trie.numerators(distinct)[back]
        score -= np.where(words == _END, 0.0, trie.denominators())[of]
        base, known = np.log10(counts + 1.0)[of], (counts > 0)[of]
        out, low = [], 0
        for place, length in zip(places, lengths):
            texts, back = np.unique(place, return_inverse=True)
            part = slice(low, low + length)
            sums = (np.bincount(back, x[part] * times[part], len(texts)) for x in (known, base, score))
            out.append([texts.tobytes(), *(s.tobytes() for s in sums)])
            low += length
        nothing = [pa.nulls(len(rows), rows.schema.field(c).type) for c in ("doc_ids", "train", "sizes")]
        return pa.table([rows["batch"], *nothing, *(pa.array(column, pa.binary()) for column in zip(*out))], names=_SUMS)

    return query


def _sum(corpus: Corpus, prior: float):
    def total(rows: pa.Table) -> pa.Table:
        texts = next(i for i, x in enumerate(rows["sizes"].to_pylist()) if x is not None)
        sizes = np.frombuffer(rows["sizes"][texts].as_py(), np.int64)
        sums = np.zeros((3, len(sizes)))
        for row in range(len(rows)):
            if row != texts:
                places = np.frombuffer(rows["places"][row].as_py(), np.uint32)
                for k, name in enumerate(("known", "base", "score")):
                    sums[k, places] += np.frombuffer(rows[name][row].as_py(), np.float64)
        train = np.unpackbits(np.frombuffer(rows["train"][texts].as_py(), np.uint8))[: len(sizes)].astype(bool)
        base = sums[1] - sizes * np.log10(corpus.tokens + corpus.words + 1)
        score = sums[2] - np.log10(corpus.texts + prior)
        columns = [rows["doc_ids"][texts].values, pa.array(~train), pa.array(sizes), pa.array(sums[0].astype(np.int64)), pa.array(np.full(len(sizes), corpus.tokens, np.int64))]
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        return pa.table([*columns, pa.array(base), pa.array(score)], names=names)

    return total


def score(docs: DataFrame, is_held_out: Column, prior: float = PRIOR) -> DataFrame:
    """Scores of every row of ``docs`` by the model of those not held out.

    Tokens are the lower-cased words of ``text`` and one end. ``n_known`` of a
    text's ``n_tokens`` occur in the ``train_tokens``; ``base_score`` is its
    log10 probability under the add-one unigram, ``score`` that under the model.
    A null or empty text has the end alone. Rows may repeat; each counts. With
    no training rows nothing is known.
    """
    marked = docs.select("doc_id", "text", F.coalesce(is_held_out, F.lit(False)).alias("held_out"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    corpus = count_corpus(marked)
    dealt = marked.mapInArrow(
        _deal(corpus),
        f"part long, batch long, doc_ids array<{kind}>, train binary, sizes binary, words binary, counts binary, contexts binary, places binary, times binary",
    )
    summed = dealt.groupBy("part").applyInArrow(
        _query(corpus, prior), f"batch long, doc_ids array<{kind}>, train binary, sizes binary, places binary, known binary, base binary, score binary"
    )
    return summed.groupBy("batch").applyInArrow(
        _sum(corpus, prior),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
