"""Quality rules: the log-likelihood ratio of hashed n-grams.

Every text is hashed into the unigrams and bigrams of its words, over a fixed
number of buckets. One multinomial over the buckets is counted from trusted
texts, another from the whole raw corpus; a text's score is the mean over its
n-grams of the log of their ratio, and a text is kept if that reaches a fixed
threshold. Nothing is drawn at random, so the same corpus gives the same
verdicts.

Copies weigh once. Texts that share one of ``BANDS`` bands of a MinHash signature
of their 3-word shingles are one group, exact and near copies alike; each row has
one part in the rows of the largest group that it is in, so that a group weighs
about as much as one text, however many rows it has. In the trusted multinomial
these are the trusted rows of the group.

The trusted texts are labelled rows. Of those at most ``LABEL_ROWS`` are used,
the ones with the smallest hashed id; all counts over the corpus and all
verdicts cover every row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage, stage_counted
from . import near_dedup
from . import words as w

LABEL_ROWS = 200_000
BUCKETS = 1 << 16
SMOOTHING = 4.0
#: Mean log-likelihood ratio, in nats an n-gram, that a kept text reaches.
THRESHOLD = -0.13
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

#: Bands of five coordinates: copies at a similarity of 0.9 share one with probability 1 - 1e-6, of 0.8 with 0.998.
BANDS = 16
SHINGLE = 3
#: The weight of a text without copies; whole numbers, so that sums do not depend on their order.
_UNIT = 1 << 20
#: Weights of texts with copies are broadcast up to this number; more are joined by a shuffle of the texts.
BROADCAST_WEIGHTS = 1_000_000

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _buckets(texts: w.Texts, words: w.Words) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each word and bigram, and their text."""
    hashes = w.hash_spans(texts.data, words.starts, words.ends)
    pairs = w.run_starts(words, 2)
    of = words.texts()
    grams = np.concatenate((w.mix(hashes + np.uint64(1)), w.chain(hashes, 2)[pairs]))
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate((of, of[pairs]))


@w.releasing
def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        weights = [batch.column(name).to_numpy() for name in ("raw", "target")]
        for low, high, texts in w.text_slices(batch.column("text")):
            grams, of = _buckets(texts, w.find_words(texts))
            for k, weight in enumerate(weights):
                # Doubles hold these sums exactly: a slice has far less than 2**33 n-grams.
                counts[k] += np.bincount(grams, weight[low:high][of], BUCKETS).astype(np.int64)
    seen = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen, pa.int32()), pa.array(counts[0][seen]), pa.array(counts[1][seen])], ["bucket", "raw", "target"]
    )


@w.releasing
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bands = []
        for _, _, texts in w.text_slices(batch.column("text")):
            sets = near_dedup.shingle_sets(texts, SHINGLE)
            keys = iter(near_dedup.band_keys(near_dedup.signatures([s for s in sets if len(s)], BANDS * near_dedup.ROWS)).tolist())
            bands += [next(keys) if len(s) else [] for s in sets]
        columns = [batch.column("text_hash"), batch.column("trusted"), pa.array(bands, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["text_hash", "trusted", "bands"])


def copies(marked: DataFrame) -> DataFrame:
    """``text_hash``, ``rows`` and ``trusted_rows`` of the largest group of each
    text that has exact or near copies."""
    signed = marked.mapInArrow(_sign, "text_hash long, trusted boolean, bands array<long>")
    trusted = F.count_if("trusted").alias("trusted_rows")
    texts = signed.groupBy("text_hash").agg(F.count(F.lit(1)).alias("rows"), trusted, F.first("bands").alias("bands"))
    texts = stage(texts, "quality-texts")
    members = texts.select("text_hash", "rows", "trusted_rows", F.explode("bands").alias("band"))
    groups = members.groupBy("band").agg(F.sum("rows").alias("rows"), F.sum("trusted_rows").alias("trusted_rows")).filter("rows > 1")
    of_text = members.select("text_hash", "band").join(groups, "band").groupBy("text_hash")
    return of_text.agg(F.max("rows").alias("rows"), F.max("trusted_rows").alias("trusted_rows"))


def _part(rows: str) -> Column:
    """The weight of one of so many rows; one row without a number is alone."""
    return F.greatest(F.lit(1), F.round(_UNIT / F.coalesce(rows, F.lit(1))).cast("long")).cast("long")


def trusted_ids(labels: DataFrame, quality: str = "quality", rows: int = LABEL_ROWS) -> DataFrame:
    """Ids of at most ``rows`` trusted rows, the same at every call."""
    ids = labels.filter(F.col(quality) == 1).filter("doc_id is not null").select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The log ratio of target to raw probability of each bucket.

    The table has ``BUCKETS`` entries whatever the corpus holds. Without a
    trusted text, or without any, all are 0.
    """
    ids = F.broadcast(trusted_ids(labels)).withColumn("trusted", F.lit(True))
    marked = docs.select("doc_id", "text").join(ids, "doc_id", "left")
    marked = marked.select("text", F.xxhash64("text").alias("text_hash"), F.coalesce("trusted", F.lit(False)).alias("trusted"))
    groups, seen = stage_counted(copies(marked), "quality-copies")
    if seen["rows"] <= BROADCAST_WEIGHTS:
        groups = F.broadcast(groups)
    target = F.when(F.col("trusted"), _part("trusted_rows")).otherwise(F.lit(0)).cast("long")
    weighed = marked.join(groups, "text_hash", "left").select("text", _part("rows").alias("raw"), target.alias("target"))
    counted = weighed.mapInArrow(_count, "bucket int, raw long, target long")
    found = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, BUCKETS))
    counts[:, found["bucket"].to_numpy()] = found["raw"].to_numpy(), found["target"].to_numpy()
    if not counts[1].any():
        return np.zeros(BUCKETS)
    raw, target = counts / _UNIT
    # Raw counts scaled to the target's total, so that a rare n-gram the sample can't hold says little.
    return np.log(target + SMOOTHING) - np.log(raw * (target.sum() / raw.sum()) + SMOOTHING)


def _text_features(texts: w.Texts, ratios: np.ndarray) -> dict[str, np.ndarray]:
    words = w.find_words(texts)
    rows, of = len(texts), words.texts()
    n_words = np.diff(words.first)

    letters = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))
    word_chars = np.bincount(of, letters[words.ends] - letters[words.starts], rows).astype(np.int64)
    symbols = np.concatenate(([0], np.cumsum(_SYMBOLS[texts.data])))
    n_symbols = symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]]

    grams, gram_of = _buckets(texts, words)
    total = np.bincount(gram_of, ratios[grams], rows)
    score = total / np.maximum(np.bincount(gram_of, minlength=rows), 1)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": n_symbols,
        "n_dup_lines": _duplicate_lines(texts, words),
        "n_repeat_words": _repeated_words(texts, words),
        "score": score,
    }


def _duplicate_lines(texts: w.Texts, words: w.Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = w.find_words(texts, w._not_in((0x0A, 0x0A)))
    with_word = np.searchsorted(words.starts, lines.starts) < np.searchsorted(words.starts, lines.ends)
    starts, ends, of = lines.starts[with_word], lines.ends[with_word], lines.texts()[with_word]
    hashes = w.hash_spans(texts.data, starts, ends, w.EXACT)
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    again = (hashes[1:] == hashes[:-1]) & (of[1:] == of[:-1])
    return np.bincount(of[1:][again], minlength=len(texts)).astype(np.int64)


def _repeated_words(texts: w.Texts, words: w.Words) -> np.ndarray:
    """Words in 3-word windows that their text holds more than once."""
    hashes = w.hash_spans(texts.data, words.starts, words.ends, w.EXACT)
    at, of = w.run_starts(words, 3), words.texts()
    windows = w.chain(hashes, 3)[at]
    order = np.lexsort((windows, of[at]))
    windows, place = windows[order], at[order]
    same = (windows[1:] == windows[:-1]) & (of[place][1:] == of[place][:-1])
    twice = place[np.concatenate((same, [False])) | np.concatenate(([False], same))] if len(place) else place
    hit = np.zeros(len(of), bool)
    for k in range(3):
        hit[twice + k] = True
    return np.bincount(of[hit], minlength=len(texts)).astype(np.int64)


_FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"


def score_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the figures of each text and its ``score``.

    Columns of ``docs`` with the name of a figure are replaced. A null or empty
    text has no words and the score 0.
    """
    ratios = log_ratios(docs, labels)
    names = [x.split()[0] for x in _FEATURES.split(", ")]
    docs = docs.drop(*names)

    @w.releasing
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_text_features(texts, ratios) for _, _, texts in w.text_slices(batch.column("text"))]
            figures = [pa.array(np.concatenate([p[name] for p in parts]) if parts else []) for name in names]
            kinds = [pa.float64() if name == "score" else pa.int64() for name in names]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(f.cast(k) for f, k in zip(figures, kinds))], [*batch.schema.names, *names]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(measure, f"{fields}, {_FEATURES}")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``score_texts`` with ``base_failed`` and ``kept``: neither base rule
    fails and the score reaches the threshold."""
    scored = score_texts(docs, labels).withColumn("base_failed", base_failed())
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, with their own columns."""
    figures = [*(x.split()[0] for x in _FEATURES.split(", ")), "base_failed", "kept"]
    aside = {c: f"own_{i}_{c}" for i, c in enumerate(docs.columns) if c in figures}
    judged = judge(docs.withColumnsRenamed(aside), labels, threshold).filter("kept").drop(*figures)
    return judged.withColumnsRenamed({new: old for old, new in aside.items()}).select(*docs.columns)
