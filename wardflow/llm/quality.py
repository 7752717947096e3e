"""Quality rules by a bitmask ledger.

Every rule is evaluated once for every text.  The ledger keeps one bit per
failed rule and the measurements behind the bits; policies are versioned masks
over those bits, so a new policy, or the effect of leaving one rule out, needs
neither the texts nor the measurements again.

Cases: a null or empty text has no words, fails ``few_words`` and has zero in
every measurement; repeated rows and equal ids each give their own row; extra
columns of the input are not read; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textscan as ts

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_shouted", "n_stutters",
)
LEDGER = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES) + ", failed long"

#: Rule name to the condition of failure over the measurements (arrays by name); the place in the list is its bit.
RULES: dict[str, Callable[[dict[str, np.ndarray]], np.ndarray]] = {
    "few_words": lambda m: m["n_words"] < 20,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 25 * m["n_words"],
    "symbol_words": lambda m: (4 * m["n_symbols"] > m["n_words"]) & (m["n_symbols"] > 10),
    "repeated_lines": lambda m: (2 * m["n_dup_lines"] > m["n_lines"]) & (m["n_dup_lines"] >= 3),
    "few_letters": lambda m: 2 * m["n_letters"] < m["word_chars"],
    "shouting": lambda m: 2 * m["n_shouted"] > m["n_words"],
    "stutters": lambda m: 10 * m["n_stutters"] > 3 * m["n_words"],
}
BITS = {name: i for i, name in enumerate(RULES)}

#: Policy versions: the rules whose failure rejects a text.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "long_words", "symbol_words", "few_letters"),
    "v2": tuple(RULES),
}
POLICY = "v2"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_LEAD = (np.arange(256) & 0xC0) != 0x80
_UPPER = np.zeros(256, bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_SMALL = np.zeros(256, bool)
_SMALL[ord("a"):ord("z") + 1] = True
_LETTER = _UPPER | _SMALL | (np.arange(256) >= 0xC3)


def measure(t: ts.Texts) -> dict[str, np.ndarray]:
    """Measurements of each row; letters are ASCII letters and all characters from U+00C0 up."""
    n = len(t.offsets) - 1
    w = ts.words(t)
    h = ts.hashes(t.data, w)
    space = ts.SPACE[t.data]
    inside = ts.running(~space)
    out = {"n_words": ts.per_row(w.row, n)}
    out["word_chars"] = ts.in_rows(t, ts.running(~space & _LEAD[t.data]))
    out["n_symbols"] = ts.in_rows(t, ts.running(_SYMBOL[t.data]))

    ln = ts.lines(t)
    used = inside[ln.end] > inside[ln.start]
    ln = ts.Spans(ln.start[used], ln.end[used], ln.row[used])
    _, later = ts.repeats(ts.hashes(t.data, ln), ln.row)
    out["n_dup_lines"] = ts.per_row(ln.row[later], n)

    at, wide = ts.windows(h, w.row, WINDOW)
    many, _ = ts.repeats(wide, w.row[at])
    edges = np.bincount(at[many], minlength=len(h) + WINDOW + 1) - np.bincount(at[many] + WINDOW, minlength=len(h) + WINDOW + 1)
    out["n_repeat_words"] = ts.per_row(w.row[np.cumsum(edges)[:len(h)] > 0], n)

    out["n_lines"] = ts.per_row(ln.row, n)
    out["n_letters"] = ts.in_rows(t, ts.running(_LETTER[t.data]))
    ups, smalls = ts.running(_UPPER[t.data]), ts.running(_SMALL[t.data])
    shouted = (ups[w.end] - ups[w.start] > 1) & (smalls[w.end] == smalls[w.start])
    out["n_shouted"] = ts.per_row(w.row[shouted], n)
    out["n_stutters"] = ts.per_row(w.row[1:][(h[1:] == h[:-1]) & (w.row[1:] == w.row[:-1])], n)
    return out


def entries(t: ts.Texts) -> dict[str, np.ndarray]:
    """Ledger entries of each row: the measurements and ``failed``, the bits of the failed rules."""
    out = measure(t)
    failed = np.zeros(len(t.offsets) - 1, np.int64)
    for name, rule in RULES.items():
        failed |= rule(out).astype(np.int64) << BITS[name]
    return out | {"failed": failed}


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Measurements and failure bits, one row per row of ``docs``."""
    names = [*MEASURES, "failed"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "text"):
            got = entries(ts.texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(got[m]) for m in names]], ["doc_id", *names])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(scan, LEDGER)


def mask(policy: str) -> int:
    return sum(1 << BITS[name] for name in POLICIES[policy])


def passes(policy: str = POLICY, failed: str = "failed") -> Column:
    """Whether a ledger row passes a policy."""
    return F.col(failed).bitwiseAND(F.lit(mask(policy))) == 0


def ablations(rows: DataFrame, policy: str = POLICY) -> DataFrame:
    """Per rule of a policy: how many fail it, fail it alone, and pass once it is left out.

    One aggregation over the bits; the output has one row per rule.
    """
    m = mask(policy)
    hit = F.col("failed").bitwiseAND(F.lit(m))
    counts = [F.count_if(hit == 0).alias("kept")]
    for name in POLICIES[policy]:
        bit = 1 << BITS[name]
        counts += [F.count_if(hit.bitwiseAND(F.lit(bit)) != 0).alias(f"f_{name}"), F.count_if(hit == bit).alias(f"a_{name}")]
    one = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_or("failed").alias("seen"), *counts)
    entries = [
        F.struct(
            F.lit(name).alias("rule"), F.col(f"f_{name}").alias("n_failed"), F.col(f"a_{name}").alias("n_alone"),
            (F.col("kept") + F.col(f"a_{name}")).alias("kept_without"),
        )
        for name in POLICIES[policy]
    ]
    return one.select(F.col("n").alias("n_rows"), "kept", F.explode(F.array(*entries)).alias("e")).select("n_rows", "kept", "e.*")


def keep(docs: DataFrame, policy: str = POLICY, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose ledger bits pass, all columns as they were; texts move through no shuffle."""
    wanted = mask(policy)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, text):
            yield b.filter(pa.array(entries(ts.texts(b.column(text)))["failed"] & wanted == 0))

    return docs.mapInArrow(scan, docs.schema)
