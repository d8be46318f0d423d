"""Packing: token sequences of near-equal fill by multiway differencing.

Documents are tokenized and cut into pieces of at most ``PIECE_TOKENS`` ids.
Each task packs blocks of its pieces on its own, with no shuffle: the largest
differencing method keeps partial partitions, one entry a window, and merges
the two that are least balanced, the heaviest entry of one with the lightest of
the other, until one partition of the block is left. If its heaviest window
holds more than the window size, the number of windows rises and the block is
partitioned again. Blocks end at ``BLOCK_TOKENS``, which bounds memory.
"""

from __future__ import annotations

import heapq
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import words as w

SEQUENCE_TOKENS = 4096
PIECE_TOKENS = 512
#: A little less than 128 full windows, so that the first number of windows mostly does.
BLOCK_TOKENS = 128 * SEQUENCE_TOKENS - 128 * 16
END_ID = 2
_TEXT_BYTES = 4 << 20
#: Words whose ids a Python worker keeps at most (about 40 MB); beyond, it starts to collect them anew.
CACHE_WORDS = 1_000_000

_PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: 1: letters and digits of ASCII, 2: its signs but for the apostrophe, which may belong to letters
_KINDS = np.array([1 if chr(c).isalnum() else 2 if 32 < c < 127 and c != 39 else 0 for c in range(128)] + [0] * 128, np.uint8)


class _Known:
    """What a Python worker keeps of a vocabulary from task to task: the ids of words
    it has met, by the hash of their bytes, but not the encoder."""

    def __init__(self, encoder):
        self.ends = np.zeros(max(encoder.get_vocab().values()) + 1, bool)
        for piece, number in encoder.get_vocab().items():
            self.ends[number] = piece.endswith("</w>")
        self.special = [token.content.encode() for token in encoder.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def add(self, hashes: np.ndarray, counts: np.ndarray, ids: list[np.ndarray]) -> None:
        """Take in words that are not known, in the order of their hashes."""
        first = len(self.pool) + np.cumsum(counts) - counts
        self.pool = np.concatenate((self.pool, *ids))
        places = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, places, hashes)
        self.first = np.insert(self.first, places, first)
        self.counts = np.insert(self.counts, places, counts)


_known: dict[str, _Known] = {}


class WordTokenizer:
    """Ids of texts by a vocabulary of word pieces that drops white space.

    Such a vocabulary gives a text the ids of its words one after the other,
    so each distinct word is encoded once and kept, by the hash of its bytes.
    Letters and digits of ASCII are told from its signs before that, and A-Z
    count as a-z, since the vocabulary does so too. New words are encoded many
    at a time, split by blanks, and their ids told apart by the pieces that end
    a word's part; if these don't add up, each word is encoded alone. A text
    that holds a special token's string is encoded whole.
    """

    def __init__(self, path: str):
        self._path, self._loaded = path, None
        if path not in _known:
            _known[path] = _Known(self._encoder)
        self._words = _known[path]

    @property
    def _encoder(self):
        """Loaded once a task has a word that is not known."""
        if self._loaded is None:
            from tokenizers import Tokenizer

            self._loaded = Tokenizer.from_file(self._path)
        return self._loaded

    def ids(self, texts: w.Texts) -> list[np.ndarray]:
        """The ids of each text."""
        known = self._words
        if len(known.hashes) > CACHE_WORDS:
            known.forget()
        words = w.find_words(texts, kinds=_KINDS)
        hashes = w.hash_spans(texts.data, words.starts, words.ends)
        distinct, seen, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        new = np.ones(len(distinct), bool)
        if len(known.hashes):
            place = np.minimum(np.searchsorted(known.hashes, distinct), len(known.hashes) - 1)
            new = known.hashes[place] != distinct
        if new.any():
            at = seen[new]
            self._learn(distinct[new], [bytes(texts.data[a:b]).decode() for a, b in zip(words.starts[at], words.ends[at])])
        place = np.searchsorted(known.hashes, distinct)[inverse]
        counts = known.counts[place]
        after = np.concatenate(([0], np.cumsum(counts)))
        flat = known.pool[np.repeat(known.first[place] - after[:-1], counts) + np.arange(after[-1])]
        borders = after[words.first]
        found = [flat[a:b] for a, b in zip(borders[:-1], borders[1:])]
        whole = texts.data.tobytes()
        if any(token in whole for token in known.special):
            for i, (a, b) in enumerate(zip(texts.offsets[:-1], texts.offsets[1:])):
                if any(token in whole[a:b] for token in known.special):
                    found[i] = np.array(self._encoder.encode(whole[a:b].decode(), add_special_tokens=False).ids, np.uint32)
        return found

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        counts, ids = [], []
        for low in range(0, len(words), 1000):
            part_counts, part_ids = self._encode(words[low : low + 1000])
            counts.append(part_counts)
            ids.append(part_ids)
        self._words.add(hashes, np.concatenate(counts), ids)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and the ids."""
        ids = np.array(self._encoder.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
        parts = np.array([len(_PRETOKEN.findall(unicodedata.normalize("NFC", word).lower())) for word in words])
        ends = np.flatnonzero(self._words.ends[ids]) + 1
        if len(ends) == parts.sum() and parts.all():
            return np.diff(ends[np.cumsum(parts) - 1], prepend=0), ids
        alone = [x.ids for x in self._encoder.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([len(x) for x in alone]), np.array([i for x in alone for i in x], np.uint32)


def difference(sizes: list[int], windows: int) -> list[list[int]]:
    """``windows`` lists of indexes into ``sizes`` with near-equal sums."""
    if windows == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(windows - 1)]
    # A partition: its sums, descending and less the least, and for each window a
    # node, which is an index into sizes or a pair of nodes; -1 is an empty window.
    pairs: list[tuple[int, int]] = []
    partitions: list[tuple[np.ndarray, np.ndarray]] = []
    heap: list[tuple[int, int]] = []
    for index, size in enumerate(sizes):
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[0], nodes[0] = size, index
        partitions.append((sums, nodes))
        heap.append((-size, index))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        (sums, nodes), (others, theirs) = partitions[a], partitions[b]
        partitions[a] = partitions[b] = None
        sums, theirs = sums + others[::-1], theirs[::-1]
        both = np.flatnonzero((nodes >= 0) & (theirs >= 0))
        merged = np.maximum(nodes, theirs)
        merged[both] = len(sizes) + len(pairs) + np.arange(len(both))
        pairs.extend(zip(nodes[both].tolist(), theirs[both].tolist()))
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        partitions.append((sums - sums[-1], merged[order]))
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), len(partitions) - 1))
    out = []
    for node in partitions[heap[0][1]][1].tolist():
        members, open_nodes = [], [node] if node >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if node < len(sizes):
                members.append(node)
            else:
                open_nodes += pairs[node - len(sizes)]
        out.append(members)
    return out


def windows_of(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows none of which passes ``capacity``; no size does."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, windows)
        if max(sum(sizes[i] for i in members) for members in found) <= capacity:
            return [members for members in found if members]
        windows += 1


SCHEMA = (
    "doc_id {kind}, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def pack(docs: DataFrame, vocabulary: str, end_id: int = END_ID, capacity: int = SEQUENCE_TOKENS, keep_ids: bool = True) -> DataFrame:
    """One row for each piece of a document: where it lies in the document and
    in its sequence, and its ids.

    A null or empty text has ``end_id`` alone. Rows with one ``doc_id`` are
    documents of their own. Other columns are left out. ``sequence_id`` counts
    within a task, after the task's number in the upper bits.
    """
    schema = SCHEMA.format(kind=docs.schema["doc_id"].dataType.simpleString())
    piece_tokens = min(PIECE_TOKENS, capacity)

    @w.releasing
    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(vocabulary)
        next_id = TaskContext.get().partitionId() << 33
        block: list[tuple[object, int, np.ndarray, int]] = []
        held = 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for low, _, texts in w.text_slices(batch.column("text"), _TEXT_BYTES):
                for key, ids in zip(keys[low:], tokenizer.ids(texts)):
                    ids = np.append(ids, np.uint32(end_id))
                    for start in range(0, len(ids), piece_tokens):
                        piece = ids[start : start + piece_tokens]
                        if held + len(piece) > BLOCK_TOKENS:
                            yield _packed(block, next_id, capacity, batch.schema.field("doc_id").type, keep_ids)
                            next_id += len(block)
                            block, held = [], 0
                        block.append((key, start, piece, len(ids)))
                        held += len(piece)
        if block:
            yield _packed(block, next_id, capacity, batch.schema.field("doc_id").type, keep_ids)

    return docs.select("doc_id", "text").mapInArrow(pack_batches, schema)


def _packed(block: list, first_id: int, capacity: int, kind: pa.DataType, keep_ids: bool) -> pa.RecordBatch:
    sizes = [len(ids) for _, _, ids, _ in block]
    rows = []
    for number, members in enumerate(windows_of(sizes, capacity)):
        offset = 0
        for index in members:
            rows.append((index, first_id + number, offset))
            offset += sizes[index]
    pieces = [block[index] for index, _, _ in rows]
    ids = [ids.astype("<u4") for _, _, ids, _ in pieces]
    held = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)),
        pa.array(np.concatenate(ids).astype(np.int32)),
    )
    return pa.RecordBatch.from_arrays(
        [
            pa.array([key for key, _, _, _ in pieces], kind),
            pa.array([start for _, start, _, _ in pieces], pa.int64()),
            pa.array([len(x) for x in ids], pa.int64()),
            held if keep_ids else pa.nulls(len(ids), held.type),
            pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
            pa.array([size for _, _, _, size in pieces], pa.int64()),
            pa.array([number for _, number, _ in rows], pa.int64()),
            pa.array([offset for _, _, offset in rows], pa.int64()),
        ],
        ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
