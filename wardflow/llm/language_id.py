"""Language identification by a convolutional network over bytes.

A window of 128 bytes (A-Z in lower case, the last one of a text filled up with
spaces) meets filters two, three and four bytes wide; the largest response of
each filter over the window feeds a softmax over the languages.  The network is
trained in numpy on a bounded sample of labelled texts: about ``PER_LANGUAGE``
documents of each language with ``WINDOWS`` windows each.  When it is applied,
the filters become tables over pairs of bytes, so a place costs five look-ups.

Every window of every text is classified; a text's language has the largest
probability averaged over its windows with letters.

Cases: a null text, and one without a letter, is ``und`` with score 0, as is every
text if no labelled text could be learned from; repeated rows each give their own
row; a null id counts as not held out; extra columns are not read; an empty table
gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import textscan as ts

LENGTH = 128
WIDTHS = (2, 3, 4)
FILTERS = 8
PER_LANGUAGE = 600
WINDOWS = 4
EPOCHS = 8
BATCH = 64
RATE = 0.01
SEED = 11
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0xC3:0xF8] = True


class Network(NamedTuple):
    """Filter weights by width (width, 256, filters), output weights and bias, and the languages."""

    filters: tuple[np.ndarray, ...]
    out: np.ndarray
    bias: np.ndarray
    languages: tuple[str, ...]


def windows(t: ts.Texts) -> tuple[np.ndarray, np.ndarray]:
    """All windows (n, LENGTH) and the text of each; an empty text has none."""
    size = np.diff(t.offsets)
    count = -(-size // LENGTH)
    first = np.concatenate([[0], np.cumsum(count)])
    out = np.full(first[-1] * LENGTH, 32, np.uint8)
    out[np.arange(len(t.data)) + np.repeat(first[:-1] * LENGTH - t.offsets[:-1], size)] = ts.LOWER[t.data]
    return out.reshape(-1, LENGTH), np.repeat(np.arange(len(size)), count)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(data: np.ndarray, label: np.ndarray, languages: tuple[str, ...], epochs: int = EPOCHS) -> Network:
    """Adam on the cross-entropy; gradients reach a filter only at its largest response."""
    rng = np.random.default_rng(SEED)
    k = len(languages)
    weights = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
    weights += [rng.normal(0, 0.3, (FILTERS * len(WIDTHS), k)).astype(np.float32), np.zeros(k, np.float32)]
    mean, square = [np.zeros_like(x) for x in weights], [np.zeros_like(x) for x in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            x, y = data[pick], label[pick]
            pooled, best = [], []
            for w, f in zip(WIDTHS, weights):
                z = sum(f[j][x[:, j:LENGTH - w + 1 + j]] for j in range(w))
                best.append(z.argmax(axis=1))
                pooled.append(np.maximum(np.take_along_axis(z, best[-1][:, None], 1)[:, 0], 0))
            h = np.concatenate(pooled, axis=1)
            d = _softmax(h @ weights[-2] + weights[-1])
            d[np.arange(len(y)), y] -= 1
            d /= len(y)
            back = (d @ weights[-2].T) * (h > 0)
            grads = []
            for i, (w, f) in enumerate(zip(WIDTHS, weights)):
                g, part = np.zeros_like(f), back[:, i * FILTERS:(i + 1) * FILTERS]
                for j in range(w):
                    np.add.at(g[j], (np.take_along_axis(x, best[i] + j, 1), np.arange(FILTERS)[None]), part)
                grads.append(g)
            grads += [h.T @ d, d.sum(axis=0)]
            step += 1
            for v, g, m, s in zip(weights, grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Network(tuple(weights[:-2]), weights[-2], weights[-1], languages)


class Applied:
    """The network with its filters as tables over pairs of bytes."""

    def __init__(self, net: Network) -> None:
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        two, three, four = net.filters
        self.net, self.third = net, three[2]
        self.two, self.head3 = pair(two[0], two[1]), pair(three[0], three[1])
        self.head4, self.tail4 = pair(four[0], four[1]), pair(four[2], four[3])

    def probabilities(self, data: np.ndarray, step: int = 2048) -> np.ndarray:
        out = np.empty((len(data), len(self.net.languages)), np.float32)
        for a in range(0, len(data), step):
            x = data[a:a + step]
            pairs = (x[:, :-1].astype(np.int32) << 8) | x[:, 1:]
            pooled = [
                self.two[pairs].max(axis=1),
                (self.head3[pairs[:, :-1]] + self.third[x[:, 2:]]).max(axis=1),
                (self.head4[pairs[:, :-2]] + self.tail4[pairs[:, 2:]]).max(axis=1),
            ]
            out[a:a + step] = _softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.out + self.net.bias)
        return out


def classify(texts: pa.Array, net: Applied) -> tuple[list[str], np.ndarray]:
    """Language and score of every text."""
    t = ts.texts(texts)
    n = len(t.offsets) - 1
    data, row = windows(t)
    lettered = _LETTER[data].any(axis=1)
    ascii_letter = ts.in_rows(t, ts.running((ts.LOWER[t.data] >= 97) & (ts.LOWER[t.data] <= 122))) > 0
    known = ascii_letter.copy()
    for i in np.flatnonzero(~ascii_letter & (np.diff(t.offsets) > 0)):
        # Without a Latin letter only Unicode's own tables tell letters from other characters.
        known[i] = any(c.isalpha() for c in t.row(i).decode())
        if known[i]:
            lettered[row == i] = True
    use = lettered & known[row]
    data, row = data[use], row[use]
    p = net.probabilities(data)
    total = np.stack([np.bincount(row, weights=p[:, j], minlength=n) for j in range(p.shape[1])], axis=1) if len(row) else np.zeros((n, len(net.net.languages)))
    count = np.bincount(row, minlength=n)
    best = total.argmax(axis=1)
    score = np.divide(total[np.arange(n), best], count, out=np.zeros(n), where=count > 0)
    return [net.net.languages[b] if c else UNKNOWN for b, c in zip(best, count)], np.clip(score, 0.0, 1.0)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Network | None:
    """Network from the labelled rows; ``key`` only decides which rows are in the sample."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(key).alias("at")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = tuple(sorted(counts))
    wanted = F.lit(False)
    for name in languages:
        # The share of the hash range that holds the wanted number of this language's rows.
        wanted = wanted | ((F.col("lang") == name) & (F.pmod("at", F.lit(1 << 40)) < int(min(1.0, PER_LANGUAGE / counts[name]) * (1 << 40))))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "text"):
            data, row = windows(ts.texts(b.column("text")))
            lettered = np.flatnonzero(_LETTER[data].mean(axis=1) > 0.3)
            first = np.searchsorted(row[lettered], np.arange(b.num_rows + 1))
            take = [lettered[np.unique(np.linspace(a, z - 1, WINDOWS).astype(int))] for a, z in zip(first, first[1:]) if z > a]
            at = np.concatenate(take) if take else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column("lang").take(pa.array(row[at])), pa.array([x.tobytes() for x in data[at]], pa.binary())], ["lang", "data"])

    most = 2 * PER_LANGUAGE * WINDOWS * len(languages)
    got = rows.where(wanted).mapInArrow(cut, "lang string, data binary").orderBy(F.xxhash64("lang", "data"), "lang", "data").limit(most).toArrow()
    if not len(got):
        return None
    data = np.frombuffer(b"".join(got.column("data").to_pylist()), np.uint8).reshape(-1, LENGTH)
    label = np.array([languages.index(x) for x in got.column("lang").to_pylist()])
    order = np.lexsort((*data.T[::-1], label))  # the same network whatever the order of rows
    return fit(data[order], label[order], languages)


RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, net: Network | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Language and score of every row of ``docs``, from its text alone."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).cast("string").alias("text"))
    if net is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        applied = Applied(sent.value)
        for b in ts.sliced(batches, "text"):
            lang, score = classify(b.column("text"), applied)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(scan, RESULT)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the labelled rows that are not held out, predict all."""
    return predict(docs, train(docs.where(~held_out(doc_id)), text, lang, doc_id), doc_id, text)
