"""Secret scans: all rules in one pass over the bytes.

The rules' regexes are one automaton (see ``automaton``). Texts are cut into
blocks that are stepped side by side, one byte of each at a time. A block
starts in the state that the bytes before it lead to from the start; where the
block before ends in another state, the block is run again from that one, so
the result is that of one pass. Only where a rule ends, its automaton read
backwards gives the start, and read forwards the longest end.

Matches of a rule do not overlap: after one ends, the next is the one that ends
first, from its leftmost start to its longest end. Then those that are too
short are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as w
from .automaton import Automaton, compile_rules, either_case

BLOCK = 2048
WARM_UP = 64
MASK = "[REDACTED]"
_SLICE_BYTES = 8 << 20
#: No UTF-8 text holds it; it stands between texts and leads back to the start.
_BORDER = 0xFF


class Rule(NamedTuple):
    """Matches of ``regex`` whose part after the longest ``head`` has at least
    ``least`` bytes. ``detect`` may replace ``regex`` in the pass over all
    bytes if it ends in every match that is long enough, and in no other. It
    may also be a beginning of each match that no other match ends in."""

    kind: str
    regex: str
    head: str = ""
    least: int = 0
    detect: str = ""


_KEY = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
_ASSIGN = rf"({_KEY})[\"\']?\x20*[:=]\x20*[\"\']?"

_KEY_LINE = "-----{} [A-Z ]*PRIVATE KEY-----"
#: Line ends and blanks, also as they stand in quoted strings.
_BREAK = r"(?:[\x20\t\r\n\"\'>#]|\\+[nrt])+"
_KEY_BEGIN = _KEY_LINE.format("BEGIN")
#: Any ASCII text without five dashes in a row, up to the END line.
_KEY_ENDED = r"[\t\n\r\x20-\x2C\x2E-\x7E]*(?:-{1,4}[\t\n\r\x20-\x2C\x2E-\x7E]+)*" + _KEY_LINE.format("END")
#: Header fields and lines of a body whose END line is missing; its last line may be short.
_KEY_CUT = rf"(?:{_BREAK}[A-Z][A-Za-z0-9-]*:[\x20-\x5B\x5D-\x7E]*)*(?:{_BREAK}[A-Za-z0-9+/=]{{20,}})+(?:{_BREAK}[A-Za-z0-9+/=]+)?"

#: The first three are the base kinds; the others add spans of their own.
RULES = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]+", _ASSIGN, 6),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]+", least=24, detect="[0-9a-f]{24,}"),
    # The header alone is a match too; the longest end takes the body.
    Rule("private_key", f"{_KEY_BEGIN}(?:{_KEY_ENDED}|{_KEY_CUT})?", detect=_KEY_BEGIN),
    Rule("code_host", "gh[oprsu]_[A-Za-z0-9]+", least=40),
    Rule("chat_bot", "xox[abprs]-[A-Za-z0-9-]+", least=20),
    Rule("signed_token", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", least=40),
)
BASE_KINDS = ("assign", "access", "hex")


class Walker:
    """The longest match from one byte on, forwards or backwards."""

    def __init__(self, regex: str, backwards: bool = False):
        found = compile_rules([regex], anywhere=False, backwards=backwards)
        self._rows = found.by_byte().tolist()
        self._accepts = (found.accepts > 0).tolist()
        stuck = (found.step == np.arange(len(found.step))[:, None]).all(1) & (found.accepts == 0)
        self._dead = set(np.flatnonzero(stuck).tolist())
        self._by = -1 if backwards else 1

    def longest(self, data: np.ndarray, at: int, limit: int) -> int:
        """Bytes of the longest match between ``at`` and ``limit``."""
        state, best, length = 0, 0, 0
        part = data[at:limit] if self._by > 0 else data[limit:at][::-1]
        for low in range(0, len(part), 256):
            for byte in part[low : low + 256].tolist():
                state = self._rows[state][byte]
                if state in self._dead:
                    return best
                length += 1
                if self._accepts[state]:
                    best = length
        return best


class Scanner:
    """The compiled rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        found = compile_rules([rule.detect or rule.regex for rule in rules], anywhere=True)
        self.automaton, self._first_accepting = _accepting_last(found)
        self.accepts = self.automaton.accepts
        step, classes = self.automaton.step, self.automaton.classes.copy()
        states, kinds = step.shape
        classes[_BORDER] = kinds
        self._width = kinds + 1
        self._classes = classes
        self._table = np.column_stack((step, np.zeros(states, np.int32))).astype(np.int32).ravel() * self._width
        self._ahead = [Walker(rule.regex) for rule in rules]
        self._back = [Walker(rule.regex, backwards=True) for rule in rules]
        self._head = [Walker(rule.head) if rule.head else None for rule in rules]

    def _run(self, columns: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Steps all blocks; the last states, and where states accept."""
        least, seen = self._first_accepting * self._width, []
        for at, column in enumerate(columns):
            state = self._table.take(state + column)
            if state.max() >= least:
                blocks = np.flatnonzero(state >= least)
                seen.append((at, blocks, state[blocks]))
        return state, seen

    def ends(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places after which a rule may have ended, in order, and the rules' bits."""
        count = max(1, -(-len(stream) // BLOCK))
        padded = np.full(count * BLOCK, self._width - 1, np.uint8)
        padded[: len(stream)] = self._classes[stream]
        columns = np.ascontiguousarray(padded.reshape(count, BLOCK).T)
        begin = np.zeros(count, np.int32)
        for column in columns[-WARM_UP:, :-1]:
            begin[1:] = self._table.take(begin[1:] + column)
        end, seen = self._run(columns, begin)
        places, states = _flat(seen, np.arange(count))
        while len(wrong := np.flatnonzero(begin[1:] != end[:-1]) + 1):
            begin[wrong] = end[wrong - 1]
            end[wrong], seen = self._run(columns[:, wrong], begin[wrong])
            keep = ~np.isin(places // BLOCK, wrong)
            more_places, more_states = _flat(seen, wrong)
            places, states = np.concatenate((places[keep], more_places)), np.concatenate((states[keep], more_states))
        order = np.argsort(places, kind="stable")
        return places[order] + 1, self.accepts[states[order] // self._width]

    def spans(self, texts: w.Texts) -> dict[int, list[tuple[int, int, int]]]:
        """For each text with a match: rule, start and end in bytes."""
        rows = len(texts)
        cuts = memoryview(texts.data.tobytes())
        stream = bytes([_BORDER]).join(cuts[a:b] for a, b in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist()))
        first = texts.offsets[:-1] + np.arange(rows)
        ends, bits = self.ends(np.frombuffer(stream, np.uint8))
        of = np.searchsorted(first, ends - 1, "right") - 1
        out = {}
        for text in np.unique(of).tolist():
            low, high = np.searchsorted(of, [text, text + 1])
            data = texts.data[texts.offsets[text] : texts.offsets[text + 1]]
            found = []
            for number in range(len(self.rules)):
                mine = ends[low:high][(bits[low:high] >> number & 1).astype(bool)] - first[text]
                found += [(number, *span) for span in self._matches(number, data, mine.tolist())]
            if found:
                out[text] = sorted(found, key=lambda x: (x[1], x[0]))
        return out

    def _matches(self, number: int, data: np.ndarray, ends: list[int]) -> Iterator[tuple[int, int]]:
        rule, last = self.rules[number], 0
        for end in ends:
            if end <= last:
                continue
            length = self._back[number].longest(data, end, last)
            if not length:
                continue
            start = end - length
            last = start + self._ahead[number].longest(data, start, len(data))
            head = self._head[number].longest(data, start, last) if self._head[number] else 0
            if last - start - head >= rule.least:
                yield start, last


def _flat(seen: list, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not seen:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    return np.concatenate([blocks[b].astype(np.int64) * BLOCK + at for at, b, _ in seen]), np.concatenate([s for _, _, s in seen])


def _accepting_last(found: Automaton) -> tuple[Automaton, int]:
    """States renumbered so that the accepting ones are the last, and the first of them."""
    order = np.argsort(found.accepts > 0, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    accepts = found.accepts[order]
    return Automaton(number[found.step[order]], found.classes, accepts), int((accepts == 0).sum())


@cache
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    """Compiled once in each Python worker."""
    return Scanner(rules)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(column: pa.Array, rules: tuple[Rule, ...]) -> Iterator[tuple[int, np.ndarray, list]]:
    """Row, bytes and spans in bytes of each text with a match."""
    scanner = _scanner(rules)
    for low, _, texts in w.text_slices(column, _SLICE_BYTES):
        for text, spans in scanner.spans(texts).items():
            yield low + text, texts.data[texts.offsets[text] : texts.offsets[text + 1]], spans


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``spans``: kind, start and end of every match in code
    points, by start and then by the rules' order. A column of this name is
    replaced; a null or empty text has none."""
    docs = docs.drop("spans")

    @w.releasing
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[] for _ in range(batch.num_rows)]
            for row, data, found in _scan(batch.column("text"), rules):
                points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80))).tolist()
                spans[row] = [{"kind": rules[k].kind, "start": points[a], "end": points[b]} for k, a, b in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, _SPANS)], [*batch.schema.names, "spans"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{fields}, spans array<struct<kind: string, start: bigint, end: bigint>>")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = MASK) -> DataFrame:
    """``docs`` with every match in ``text`` replaced by ``mask``; matches that
    overlap by one. ``n_chars``, if there, is counted again for those rows."""
    count = "n_chars" in docs.columns

    @w.releasing
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            changed = {row: _masked(data, spans, mask) for row, data, spans in _scan(texts, rules)}
            if changed:
                columns = dict(zip(batch.schema.names, batch.columns))
                columns["text"] = _replaced(texts, changed)
                if count:
                    columns["n_chars"] = _replaced(columns["n_chars"], {row: len(text) for row, text in changed.items()})
                batch = pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)
            yield batch

    return docs.mapInArrow(replace, docs.schema)


def _masked(data: np.ndarray, spans: list[tuple[int, int, int]], mask: str) -> str:
    whole, out, last = data.tobytes(), [], 0
    for _, start, end in spans:
        if start >= last:
            out += [whole[last:start], mask.encode()]
        last = max(last, end)
    return b"".join([*out, whole[last:]]).decode()


def _replaced(column: pa.Array, values: dict) -> pa.Array:
    """The rows that ``values`` has are replaced, the others stay in place."""
    rows = sorted(values)
    parts, last = [], 0
    for row in rows:
        parts += [column.slice(last, row - last), pa.array([values[row]], column.type)]
        last = row + 1
    return pa.concat_arrays([*parts, column.slice(last)])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
