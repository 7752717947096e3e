"""Secret scans by one automaton for all rules.

The rule regexes are turned into one nondeterministic automaton over UTF-8
bytes, made deterministic by subset construction and minimised by partition
refinement.  The result is one flat transition array: a text is read byte by
byte once, whatever the number of rules.  That pass runs from the end of the
text to its beginning, over the reversed heads of the rules, so an accepting state
names the rules whose head begins at this place.  From such a place the rule's
own table, built and minimised likewise, runs to the end of the longest match; places
inside an earlier match of the rule are passed over.  So spans are the leftmost,
longest and non-overlapping ones of each rule.

Cases: a null or empty text has no spans; repeated rows and equal ids each give
their own row; extra columns are not read; an empty table gives an empty result.
Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as rc, _parser as rp
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import textscan as ts


class Rule(NamedTuple):
    """A rule as regexes over ASCII.

    ``head`` goes into the automaton of all rules: the beginning that every match has,
    cut where an open-ended run starts.  (Open runs of several rules in one
    automaton would multiply its states.)  ``pattern`` is the whole rule; a
    match uses up its text and is dropped if it has under ``least`` characters
    behind ``lead``, the part that does not count.
    """

    kind: str
    head: str
    pattern: str
    least: int = 1
    lead: str = ""


_ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
#: The base rules, in their listed order.
BASE = (
    Rule("assign", _ASSIGN + "[A-Za-z0-9+/_.=-]", _ASSIGN + "([A-Za-z0-9+/_.=-]+)", 12, _ASSIGN),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16}", "[0-9a-f]+", 16),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]", "gh[pousr]_[A-Za-z0-9]+", 36),
    Rule("webtoken", "eyJ[A-Za-z0-9_-]", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]", "xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("payment", "[rs]k_(live|test)_[A-Za-z0-9]", "[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("private_key", "-----BEGIN [A-Z]", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE + MORE


class Automaton(NamedTuple):
    """Next state by state and byte, and the rules complete in each state."""

    table: np.ndarray
    rules: tuple[tuple[int, ...], ...]


class _Graph:
    """Nondeterministic automaton: byte arcs and empty arcs between numbered states; ``backward`` ones read reversed texts."""

    def __init__(self, backward: bool = False) -> None:
        self.backward = backward
        self.arcs: list[list[tuple[np.ndarray, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.arcs.append([])
        self.free.append([])
        return len(self.arcs) - 1

    def bytes_of(self, op, value, fold: bool) -> np.ndarray:
        got = np.zeros(256, bool)
        if op is rc.LITERAL:
            got[value] = True
        elif op is rc.RANGE:
            got[value[0]:value[1] + 1] = True
        elif op is rc.IN:
            for o, v in value:
                if o is not rc.NEGATE:
                    got |= self.bytes_of(o, v, fold)
            if value[0][0] is rc.NEGATE:
                got = ~got
        else:
            raise ValueError(f"not supported in a rule: {op}")
        if fold:
            up, low = slice(ord("A"), ord("Z") + 1), slice(ord("a"), ord("z") + 1)
            got[up] = got[low] = got[up] | got[low]
        return got

    def add(self, items, at: int, fold: bool) -> int:
        """Append parsed items behind state ``at``; the state behind them."""
        for op, value in reversed(items) if self.backward else items:
            if op is rc.SUBPATTERN:
                at = self.add(value[3], at, fold or bool(value[1] & re.IGNORECASE))
            elif op is rc.BRANCH:
                end = self.state()
                for branch in value[1]:
                    self.free[self.add(branch, at, fold)].append(end)
                at = end
            elif op is rc.MAX_REPEAT:
                low, high, inner = value
                for _ in range(low):
                    at = self.add(inner, at, fold)
                if high is rc.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(inner, loop, fold)].append(loop)
                    at = loop
                else:
                    end = self.state()
                    for _ in range(high - low):
                        self.free[at].append(end)
                        at = self.add(inner, at, fold)
                    self.free[at].append(end)
                    at = end
            else:
                step = self.state()
                self.arcs[at].append((self.bytes_of(op, value, fold), step))
                at = step
        return at


def compile_patterns(patterns: list[str], backward: bool = False, anywhere: bool = False) -> Automaton:
    """Subset construction and minimisation; state 0 is the start, matches begin there or, if ``anywhere``, at any place."""
    g = _Graph(backward)
    root, ends = g.state(), {}
    for i, pattern in enumerate(patterns):
        first = g.state()
        g.free[root].append(first)
        ends[g.add(rp.parse(pattern), first, False)] = i
    again = {root} if anywhere else set()

    def closure(states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for nxt in g.free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)

    # Bytes that no arc tells apart form one class; the first row serves patterns without an arc.
    masks = np.array([np.zeros(256, bool), *(m for arcs in g.arcs for m, _ in arcs)])
    _, kind = np.unique(masks, axis=1, return_inverse=True)
    sample = [int(np.flatnonzero(kind == k)[0]) for k in range(kind.max() + 1)]
    goes = [[[t for m, t in arcs if m[byte]] for byte in sample] for arcs in g.arcs]
    start = closure([root])
    number, order, moves = {start: 0}, [start], []
    for now in order:
        row = []
        for k in range(len(sample)):
            to = closure({*again, *(t for s in now for t in goes[s][k])})
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        moves.append(row)
    step = np.array(moves)
    found = [tuple(sorted({ends[s] for s in states if s in ends})) for states in order]
    names = {f: i for i, f in enumerate(dict.fromkeys(found))}
    block = np.array([names[f] for f in found])
    while True:
        finer = np.unique(np.column_stack([block, block[step]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    _, heads = np.unique(block, return_index=True)
    heads = np.sort(heads)  # the start state stays first
    place = np.empty(len(heads), np.int64)
    place[block[heads]] = np.arange(len(heads))
    return Automaton(place[block[step[heads]]][:, kind].astype(np.int32), tuple(found[s] for s in heads))


class Tables(NamedTuple):
    """The automaton of all heads, read backward, and per rule the tables of its whole pattern and of its lead."""

    heads: Automaton
    wholes: tuple[Automaton, ...]
    leads: tuple[Automaton, ...]


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Automaton:
    """One automaton of all heads; it reads a text backward and accepts where a head begins."""
    return compile_patterns([r.head for r in rules], backward=True, anywhere=True)


def compile_tables(rules: tuple[Rule, ...] = RULES) -> Tables:
    return Tables(compile_rules(rules), tuple(compile_patterns([r.pattern]) for r in rules), tuple(compile_patterns([r.lead]) for r in rules))


def _linked(automaton: Automaton) -> list:
    """The start row of a transition array as linked rows: byte to next row, None where no match is left; entry 256: the rules complete there."""
    rows = [[] for _ in automaton.rules]
    table = automaton.table.tolist()
    dead = [not done and all(x == i for x in to) for i, (to, done) in enumerate(zip(table, automaton.rules))]
    for row, to, complete in zip(rows, table, automaton.rules):
        row += [None if dead[x] else rows[x] for x in to]
        row.append(complete)
    return rows[0]


def _longest(row: list, data: bytes, start: int, failed: dict[int, list]) -> int:
    """End of the longest match from ``start``, -1 if there is none.

    ``failed`` keeps the row at each place of the last run without a match: a run that
    comes to the same row there has no more to find, so failing runs do not add up.
    """
    end = start if row[256] else -1
    seen = {}
    for i in range(start, len(data)):
        row = row[data[i]]
        if row is None or failed.get(i) is row:
            break
        if row[256]:
            end = i + 1
        elif end < 0:
            seen[i] = row
    if end < 0:
        failed.update(seen)
    return end


class Scanner:
    """The tables as linked rows."""

    def __init__(self, tables: Tables, rules: tuple[Rule, ...]) -> None:
        self.start, self.rules = _linked(tables.heads), rules
        self.wholes = [_linked(a) for a in tables.wholes]
        self.leads = [_linked(a) for a in tables.leads]

    def heads(self, data: bytes) -> dict[int, list[int]]:
        """Places where a head begins, falling, by rule: the one pass over the text."""
        out: dict[int, list[int]] = {}
        row, i = self.start, len(data)
        for byte in reversed(data):
            row = row[byte]
            i -= 1
            if row[256]:
                for r in row[256]:
                    out.setdefault(r, []).append(i)
        return out

    def find(self, data: bytes) -> list[tuple[int, int, int]]:
        """Spans (start, rule, end) in bytes, leftmost and non-overlapping within each rule, ordered."""
        out = []
        for r, places in self.heads(data).items():
            done, failed = 0, {}
            for start in reversed(places):
                if start < done:
                    continue
                end = _longest(self.wholes[r], data, start, failed)
                if end < 0:
                    continue
                done = end
                if end - _longest(self.leads[r], data, start, {}) >= self.rules[r].least:
                    out.append((start, r, end))
        return sorted(out)

    def masked(self, data: bytes) -> bytes:
        """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
        out, done = [], 0
        for start, r, end in self.find(data):
            if start >= done:
                out += [data[done:start], f"<{self.rules[r].kind}>".encode()]
            done = max(done, end)
        return b"".join([*out, data[done:]]) if out else data


_scanners: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...], tables: Tables | None = None) -> Scanner:
    """Scanner of these rules, kept for the life of the process."""
    if rules not in _scanners:
        _scanners[rules] = Scanner(tables or compile_tables(rules), rules)
    return _scanners[rules]


def _points(data: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Byte offsets to code-point offsets."""
    if not spans or data.isascii():
        return spans
    before = ts.running((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    return [(int(before[a]), r, int(before[b])) for a, r, b in spans]


SPANS = "doc_id long, spans array<struct<start: int, kind: string, end: int>>"


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs`` with its spans, by start and then by rule."""
    tables = docs.sparkSession.sparkContext.broadcast(compile_tables(rules))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(rules, tables.value).find
        for b in ts.sliced(batches, "text"):
            t = ts.texts(b.column("text"))
            rows = []
            for i in range(b.num_rows):
                data = t.row(i)
                rows.append([{"start": s, "kind": rules[r].kind, "end": e} for s, r, e in _points(data, find(data))])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, kind)], ["doc_id", "spans"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(read, SPANS)


def redact(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows with spans masked in the text; texts without a span, nulls too, stay as they are."""
    tables = docs.sparkSession.sparkContext.broadcast(compile_tables(rules))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masked = scanner(rules, tables.value).masked
        for b in ts.sliced(batches, text):
            column, t = b.column(text), ts.texts(b.column(text))
            new, changed = [], False
            for i in range(b.num_rows):
                data = t.row(i)
                clean = masked(data)
                changed |= clean is not data
                new.append(clean.decode())
            if changed:
                at = b.schema.get_field_index(text)
                texts = pa.array([x if ok else None for x, ok in zip(new, column.is_valid().to_pylist())], column.type)
                arrays = list(b.columns)
                arrays[at] = texts
                b = pa.RecordBatch.from_arrays(arrays, schema=b.schema)
            yield b

    out = docs.mapInArrow(read, docs.schema)
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(F.col(n_chars).isNotNull() & F.col(text).isNotNull(), F.char_length(text).cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars)))
    return out
