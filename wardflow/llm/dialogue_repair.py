"""Repair of conversation structure by iterative-deepening A*.

A sound conversation has role initials ``(s?(ua)+)?``, no blank row, no row that
repeats an earlier one (same role and text), and no row that breaks off.  Edits are
Delete (D, 3; needed for blank and repeated rows), Insert an empty user or assistant
row (I, 2), Keep (K, 0) and Rerole to user or assistant (R, 2); a truncated row that
stays adds 1.  What role an insert or rerole gives follows from the rows before it,
so a string of edit letters says everything.  Wanted is the cheapest, of equally
cheap ones the least string.

The search goes depth first through the letters in ASCII order under a cost bound
that starts at a lower bound of the whole cost and rises to the least cost that was
cut off.  A table keeps, for every failed state, the cost it needs at least.  The
first path that is accepted is the answer.

Only one letter per distinct row (role initial and fault) is searched, never a text.
Rows are sorted over all partitions by conversation, turn, role and text digest and
cut into pieces of at most ``PIECE`` rows, so a conversation of any length is searched
by many tasks: for every piece the costs between its four states before and after;
backwards over a conversation's pieces the cost of the rest; for every piece the best
edits before that rest from each state; forwards the states that are met.  A piece's
edits end with one that takes a row, so of two different strings neither begins with
the other and the least whole string is made of the least pieces.  Both passes over
pieces and the last one over the texts are streams that hold one piece or one text.

Cases: a null role or text reads as one space; rows come by turn (nulls first), those
of one turn by role, then by MD5 of the text; repeated rows are repeated turns; rows
without a conversation id are one conversation; extra columns are not read; an empty
table gives no row.  Equal texts are found by their MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..functions.segments import durable

PIECE = 64
NEVER = 1 << 60
DELETE, INSERT, REROLE, BROKEN = 3, 2, 2, 1
#: States: nothing yet, after system, after user, after assistant.  Which initials may follow, and the role an edit gives.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
GIVES = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Cost and edits that finish a conversation.
FINISH = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
LEGAL = ("su", "ua", "au")
_SPACE = " \t\n\x0b\x0c\r"


class Way(NamedTuple):
    """Cost up to the end of the piece, edit letters, state after it."""

    cost: int
    edits: str
    state: int


def reachable(codes: str, ends: frozenset[int]) -> list[frozenset[int]]:
    """For every place, the states from which some edits lead to one of ``ends``; else inserts could go round for ever."""
    out = [ends]
    for c in reversed(codes):
        after = out[-1]
        now = set(after)  # by deleting the row
        if c != "x":
            now |= {q for q in range(4) if GIVES[q] in after or FOLLOWS[q].get(c.lower()) in after}
            for _ in range(2):
                now |= {q for q in range(4) if GIVES[q] in now}
        out.append(frozenset(now))
    return out[::-1]


def bounds(codes: str) -> Callable[[int, int], int]:
    """Lower bound of the cost from row i on in state q.

    Rows that must go cost 3, truncated ones 1 at least.  Of the other rows, neighbours
    that may not follow each other need edits: an insert mends one such pair for 2, a
    rerole two for 2, a deletion two for 3 (2 beyond what a truncated row costs anyway),
    so each pair costs 1 at least.
    """
    n = len(codes)
    cost, following = [0] * (n + 1), [""] * (n + 1)
    for i in range(n - 1, -1, -1):
        c = codes[i]
        if c == "x":
            cost[i], following[i] = cost[i + 1] + DELETE, following[i + 1]
        else:
            wrong = following[i + 1] != "" and c.lower() + following[i + 1] not in LEGAL
            cost[i], following[i] = cost[i + 1] + (BROKEN if c.isupper() else 0) + wrong, c.lower()
    return lambda i, q: cost[i] + (following[i] != "" and following[i] not in FOLLOWS[q])


@lru_cache(1 << 15)
def search(codes: str, start: int, rest: tuple[int, ...]) -> Way | None:
    """Cheapest, then least, edits of a piece from state ``start``, when state q after it costs ``rest[q]`` more.

    ``codes`` has one letter a row: x must go, s, u, a and o (other) name the role, upper case a truncated row.
    """
    n, least, at_least = len(codes), min(rest), bounds(codes)
    open_states = reachable(codes, frozenset(q for q in range(4) if rest[q] < NEVER))
    table: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def need(i: int, q: int) -> int:
        if i == n:
            return rest[q]
        if q not in open_states[i]:
            return NEVER
        known = table.get((i, q))
        return at_least(i, q) + least if known is None else known

    def moves(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        c = codes[i]
        yield "D", DELETE, i + 1, q
        if c == "x":  # an insert may as well follow the deletion, whose letter is less
            return
        yield "I", INSERT, i, GIVES[q]
        role, broken = c.lower(), BROKEN if c.isupper() else 0
        to = FOLLOWS[q].get(role)
        if to is not None:
            yield "K", broken, i + 1, to
        if to != GIVES[q]:  # else keeping does the same for less
            yield "R", REROLE + broken, i + 1, GIVES[q]

    def descend(i: int, q: int, left: int) -> int | None:
        """The state at the end if the rest can be had for ``left``."""
        if need(i, q) > left:
            return None
        if i == n:
            return q
        failed = NEVER
        for letter, cost, j, r in moves(i, q):
            path.append(letter)
            end = descend(j, r, left - cost)
            if end is not None:
                return end
            path.pop()
            failed = min(failed, cost + need(j, r))
        table[i, q] = failed
        return None

    bound = need(0, start)
    while bound < NEVER:
        end = descend(0, start, bound)
        if end is not None:
            return Way(bound - rest[end], "".join(path), end)
        bound = need(0, start)
    return None


def ways(codes: str) -> list[int]:
    """Cheapest cost from each state before a piece to each state after it, 16 numbers."""
    out = []
    for q in range(4):
        for to in range(4):
            way = search(codes, q, tuple(0 if s == to else NEVER for s in range(4)))
            out.append(way.cost if way else NEVER)
    return out


def before(costs: list[int], rest: tuple[int, ...]) -> tuple[int, ...]:
    """Cost of the rest in each state before a piece, from that after it."""
    return tuple(min(NEVER, *(costs[4 * q + to] + rest[to] for to in range(4))) for q in range(4))


def price(codes: str, edits: str, copies: list[int]) -> int:
    """Cost of a piece's edits; further copies of a row are deleted."""
    total, at = DELETE * (sum(copies) - len(copies)), 0
    for e in edits:
        total += {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[e]
        if e != "I":
            total += BROKEN if e != "D" and codes[at].isupper() else 0
            at += 1
    return total


KEY = ["conv_id", "turn", "role", "digest"]


def read(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, digest) with nulls as one space."""
    said = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
    )
    return said.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))


def cells(said: DataFrame) -> DataFrame:
    """One row per distinct (conversation, turn, role, text): its copies, faults and whether it is the first of its role and text."""
    end = F.rtrim("text", F.lit(_SPACE))
    flags = said.select(*KEY, (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("broken"))
    held = durable(flags.groupBy(*KEY).agg(F.count(F.lit(1)).alias("copies"), F.max("blank").alias("blank"), F.max("broken").alias("broken")))
    # The struct orders null turns first.
    first = held.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n"))
    again = first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    joined = held.join(again, same, "left").withColumn("fresh", F.col("first").isNull() | F.col("turn").eqNullSafe(F.col("first.turn")))
    initial = F.when(F.left("role", F.lit(1)).isin("s", "u", "a"), F.left("role", F.lit(1))).otherwise("o")
    code = F.when(F.col("blank") | ~F.col("fresh"), "x").when(F.col("broken"), F.upper(initial)).otherwise(initial)
    return joined.select(*KEY, "copies", "blank", "broken", "fresh", initial.alias("initial"), code.alias("code"))


def counts(found: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) from the cells; each row counts for its first fault."""
    wide = lambda c: c.cast("decimal(20,0)")
    span = wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count_distinct("turn")
    one = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return found.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.col("fresh").cast("long"))).alias("duplicate"),
        one(~F.col("blank") & F.col("fresh") & F.col("broken")).alias("truncated"),
    )


def _ordered(rows: DataFrame, *more: str, falling: bool = False) -> DataFrame:
    """All rows of a conversation in one partition, in order; they are read as a stream."""
    order = [F.desc_nulls_last(c) if falling else F.asc_nulls_first(c) for c in [*KEY, *more]]
    return rows.repartition("conv_id").sortWithinPartitions(*order)


def _out(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _streamed(items: Iterator[dict], schema: pa.Schema, rows: int = 2048, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    held, much = [], 0
    for item in items:
        held.append(item)
        much += len(item.get("text") or "") + len(item.get("audit") or "")
        if len(held) >= rows or much >= size:
            yield _out(held, schema)
            held, much = [], 0
    if held:
        yield _out(held, schema)


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(0, b.num_rows, 256):
            yield from b.slice(i, 256).to_pylist()


_KEY_SQL, _KEY_PA = "conv_id long, turn long, role string, digest binary", [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary())]
_PIECE_PA = [*_KEY_PA, ("codes", pa.string()), ("initials", pa.string()), ("copies", pa.list_(pa.int64()))]
_PIECE_SQL = f"{_KEY_SQL}, codes string, initials string, copies array<long>"


def pieces(found: DataFrame, most: int = PIECE) -> DataFrame:
    """Runs of at most ``most`` cells of one conversation, keyed by their first cell, with the costs between their states."""
    schema = pa.schema([*_PIECE_PA, ("costs", pa.list_(pa.int64()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[dict]:
            now = None
            for r in _items(batches):
                if now is None or now["conv_id"] != r["conv_id"] or len(now["codes"]) == most:
                    if now is not None:
                        yield now | {"costs": ways(now["codes"])}
                    now = {c: r[c] for c in KEY} | {"codes": "", "initials": "", "copies": []}
                now["codes"] += r["code"]
                now["initials"] += r["initial"]
                now["copies"].append(r["copies"])
            if now is not None:
                yield now | {"costs": ways(now["codes"])}
        yield from _streamed(runs(), schema)

    order = [F.asc_nulls_first(c) for c in KEY]
    sorted_cells = found.select(*KEY, "copies", "initial", "code").repartitionByRange(*order).sortWithinPartitions(*order)
    return sorted_cells.mapInArrow(cut, f"{_PIECE_SQL}, costs array<long>")


def with_rest(cut: DataFrame) -> DataFrame:
    """The pieces with the cost of all that follows, by state after the piece: one pass from the end."""
    schema = pa.schema([*_PIECE_PA, ("rest", pa.list_(pa.int64()))])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[dict]:
            conv, rest, begun = None, (), False
            for r in _items(batches):
                if not begun or r["conv_id"] != conv:
                    conv, rest, begun = r["conv_id"], tuple(c for c, _ in FINISH), True
                costs = r.pop("costs")
                yield r | {"rest": list(rest)}
                rest = before(costs, rest)
        yield from _streamed(runs(), schema)

    return _ordered(cut, falling=True).mapInArrow(back, f"{_PIECE_SQL}, rest array<long>")


def solved(rests: DataFrame) -> DataFrame:
    """The pieces with the best edits from each state, spread anew over all tasks."""
    schema = pa.schema([*_PIECE_PA, ("edits", pa.list_(pa.string())), ("ends", pa.list_(pa.int64()))])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[dict]:
            for r in _items(batches):
                rest = tuple(r.pop("rest"))
                best = [search(r["codes"], q, rest) for q in range(4)]
                yield r | {"edits": [w.edits if w else None for w in best], "ends": [w.state if w else None for w in best]}
        yield from _streamed(runs(), schema)

    return rests.repartition(*KEY).mapInArrow(solve, f"{_PIECE_SQL}, edits array<string>, ends array<long>")


def chosen(best: DataFrame) -> DataFrame:
    """(key, edits, tail, state, cost, illegal) of every piece: one pass from the start picks the edits of the state that is met."""
    schema = pa.schema([*_KEY_PA, ("edits", pa.string()), ("tail", pa.string()), ("state", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64())])

    def forth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def runs() -> Iterator[dict]:
            now, state, last = None, 0, ""

            def end() -> dict:
                cost, tail = FINISH[state]
                return now | {"tail": tail, "cost": now["cost"] + cost}

            for r in _items(batches):
                if now is not None and now["conv_id"] != r["conv_id"]:
                    yield end()
                    now = None
                if now is None:
                    state, last = 0, ""
                else:
                    yield now
                initials = "".join(c if n == 1 else c + c for c, n in zip(r["initials"], r["copies"]))
                row = last + initials
                # Pairs within copies beyond the second are like that of the first two.
                illegal = sum(row[i:i + 2] not in LEGAL for i in range(len(row) - 1)) + sum(n - 2 for n in r["copies"] if n > 2)
                edits = r["edits"][state]
                now = {c: r[c] for c in KEY} | {"edits": edits, "tail": "", "state": state, "cost": price(r["codes"], edits, r["copies"]), "illegal": illegal}
                state, last = r["ends"][state], initials[-1]
            if now is not None:
                yield end()
        yield from _streamed(runs(), schema)

    return _ordered(best).mapInArrow(forth, f"{_KEY_SQL}, edits string, tail string, state long, cost long, illegal long")


class Step(NamedTuple):
    """One edit: its letter, the turn and role before it, the role and text after it; an empty letter closes a conversation with its cost."""

    conv_id: int | None
    letter: str
    turn: int | None
    was: str | None
    role: str | None
    text: str | None
    cost: int = 0
    illegal: int = 0


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[Step]:
    """Edits in order from a stream of pieces, each in front of the texts it is about."""
    conv, begun, key, edits, tail, state, cost, illegal = None, False, None, iter(""), "", 0, 0, 0

    def inserted() -> Step:
        nonlocal state
        state = GIVES[state]
        return Step(conv, "I", None, None, ROLE[state], "")

    def close() -> Iterator[Step]:
        for _ in tail:
            yield inserted()
        yield Step(conv, "", None, None, None, None, cost, illegal)

    for r in _items(batches):
        if begun and r["conv_id"] != conv:
            yield from close()
            begun = False
        if not begun:
            conv, begun, key, cost, illegal = r["conv_id"], True, None, 0, 0
        if r["kind"] == 0:
            edits, tail, state, cost, illegal = iter(r["edits"]), r["tail"], r["state"], cost + r["cost"], illegal + r["illegal"]
            continue
        this = (r["turn"], r["role"], r["digest"])
        if this == key:  # a further copy
            yield Step(conv, "D", r["turn"], r["role"], None, r["text"])
            continue
        key = this
        while (letter := next(edits)) == "I":
            yield inserted()
        if letter == "D":
            yield Step(conv, "D", r["turn"], r["role"], None, r["text"])
            continue
        state = GIVES[state] if letter == "R" else FOLLOWS[state][r["role"][0]]
        yield Step(conv, letter, r["turn"], r["role"], ROLE[state] if letter == "R" else r["role"], r["text"])
    if begun:
        yield from close()


class Repair(NamedTuple):
    """Rows as read, their cells, and the chosen edits by piece."""

    said: DataFrame
    found: DataFrame
    plan: DataFrame

    def _stream(self) -> DataFrame:
        texts = self.said.select(*KEY, F.lit(1).alias("kind"), "text")
        plan = self.plan.select(*KEY, F.lit(0).alias("kind"), "edits", "tail", "state", "cost", "illegal")
        return _ordered(plan.unionByName(texts, allowMissingColumns=True), "kind")

    def rows(self) -> DataFrame:
        """(conv_id, place, edit, turn, was, role, text): every edit in order; a deleted row has no new role."""
        schema = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("was", pa.string()), ("role", pa.string()), ("text", pa.string())])

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def items() -> Iterator[dict]:
                place = 0
                for s in _walk(batches):
                    if s.letter:
                        yield {"conv_id": s.conv_id, "place": place, "edit": s.letter, "turn": s.turn, "was": s.was, "role": s.role, "text": s.text}
                    place = place + 1 if s.letter else 0
            yield from _streamed(items(), schema)

        return self._stream().mapInArrow(each, "conv_id long, place long, edit string, turn long, was string, role string, text string")

    def audits(self) -> DataFrame:
        """(conv_id, cost, illegal, audit, repaired_sha256): the digest runs along with the stream of texts."""
        schema = pa.schema([("conv_id", pa.int64()), ("cost", pa.int64()), ("illegal", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def items() -> Iterator[dict]:
                letters, sha, begun = [], hashlib.sha256(), False
                for s in _walk(batches):
                    if not s.letter:
                        yield {"conv_id": s.conv_id, "cost": s.cost, "illegal": s.illegal, "audit": "".join(letters), "repaired_sha256": sha.hexdigest()}
                        letters, sha, begun = [], hashlib.sha256(), False
                        continue
                    letters.append(s.letter)
                    if s.role is not None:
                        sha.update((("\n" if begun else "") + s.role + ":" + s.text).encode())
                        begun = True
            yield from _streamed(items(), schema)

        return self._stream().mapInArrow(each, "conv_id long, cost long, illegal long, audit string, repaired_sha256 string")


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", piece: int = PIECE) -> Repair:
    """Search the cheapest edits of every conversation."""
    said = read(rows, conv_id, turn, role, text)
    found = durable(cells(said))
    return Repair(said, found, durable(chosen(solved(with_rest(pieces(found, piece))))))


def report(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    done = repair(rows, conv_id, turn, role, text)
    audits = done.audits().withColumnRenamed("conv_id", "c")
    both = counts(done.found).join(audits, F.col("conv_id").eqNullSafe(F.col("c")))
    return both.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
