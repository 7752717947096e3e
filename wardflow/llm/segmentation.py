"""SentencePiece encoding by sampling without replacement, and decoding.

The lattice of a text has an arc for every piece of the model that fits at a
place; a character that no piece spells goes through its bytes.  Arc weights are
the model's scores if it is a unigram model and the Zipf weight of the merge
rank if it is a merge model.  Summing weights from the right gives the exact
mass behind every place, hence the probability of every arc given its place.

``k`` distinct segmentations come from a perturbed A-star search.  A node of the
search is a beginning of a segmentation, its key the largest Gumbel-perturbed
log-probability of all segmentations that begin so.  The key is exact, so the
search walks straight down from the node with the largest key; at every arc it
takes, the arcs it leaves form one node whose key is a Gumbel variable of their
common mass, cut off at the key above.  The first k completed segmentations are
the top k of independently perturbed log-probabilities: samples without
replacement.  With the next key t, a segmentation of log-probability p had been
included with probability 1 - exp(-exp(p - t)), the inclusion score.

All random numbers are hashes of the row key, the sample, the place and the
step, so a lost task repeats its output.  Pieces never reach over the start of a
run of spaces, so places are worked on as one sequence of short chunks: equal
chunks share their lattice, and all chunks of a slice are walked in step.

Cases: a null or empty text has one segmentation without pieces; a text with
fewer than k segmentations gives them all; a null key counts as 0; rows with
equal key and text give equal samples; extra columns are not read; an empty
table gives no row.  Decoding gives back the exact text, null as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import textscan as ts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SMOOTHING = 1.0
SEED = 17
_GAP, _LITERAL_GAP = 0x2581, 0x110000
_SLOT_BITS = 19
_BACK = 12.0  # a byte costs this much more than the rarest piece
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


_STEPS = np.arange(1024, dtype=np.uint64) * _K[3]
_LENGTHS = np.arange(256, dtype=np.uint64) * _K[2]


class Model(NamedTuple):
    """Pieces as arrays.

    ``letters`` says of every code point whether a piece holds it.  ``slot`` is a hash table of the beginnings of pieces: the upper bits of a hash
    lead to its entry in ``hashes``, others with equal upper bits follow by
    ``chain``; ``ids`` has the piece, -1 for a beginning that is none itself.
    """

    weight: np.ndarray
    hashes: np.ndarray
    ids: np.ndarray
    slot: np.ndarray
    chain: np.ndarray
    longest: int
    letters: np.ndarray
    byte_id: np.ndarray
    data: np.ndarray
    start: np.ndarray
    back: float


def _code_hash(code: np.ndarray) -> np.ndarray:
    return ts.mix(code.astype(np.uint64) + _K[1])


def _span_hash(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(code)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_code_hash(code) * ts._power("inverse", ts._INVERSE, n), out=total[1:])
    return ts.mix((total[end] - total[start]) * ts._power("base", ts._BASE, n + 1)[start] ^ (end - start).astype(np.uint64) * _K[2])


def load(path: str = MODEL, smoothing: float = SMOOTHING) -> Model:
    """The model's normal and byte pieces, read once on the driver."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) for i in range(n)]
    normal = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    if any("▁" in p.lstrip("▁") for p in (pieces[i] for i in normal)):
        raise ValueError("a piece reaches over the start of a run of spaces")
    score = np.array([sp.get_score(i) for i in range(n)])
    merges = len(normal) > 1 and all(float(x).is_integer() for x in score[normal])
    weight = smoothing * (-np.log(2.0 - score) if merges else score)
    byte_id = np.full(256, -1)
    text = [b""] * n
    for i in range(n):
        if sp.is_byte(i):
            byte_id[int(pieces[i][3:5], 16)] = i
            text[i] = bytes([int(pieces[i][3:5], 16)])
    if (byte_id < 0).any():
        raise ValueError("the model has no piece for some byte")
    for i in normal:
        text[i] = pieces[i].replace("▁", " ").encode()
    # All beginnings of pieces are entries, so that a place is given up once no piece goes on.
    entry = dict.fromkeys((pieces[i][:k] for i in normal for k in range(1, len(pieces[i]) + 1)), -1)
    entry.update({pieces[i]: i for i in normal})
    length = np.array([len(x) for x in entry], np.int64)
    code = np.frombuffer("".join(entry).encode("utf-32-le"), np.uint32).astype(np.int64)
    at = np.cumsum(length) - length
    hashes = _span_hash(code, at, at + length)
    slot, chain = np.full(1 << _SLOT_BITS, -1, np.int32), np.full(len(entry), -1, np.int32)
    for k, place in enumerate((hashes >> np.uint64(64 - _SLOT_BITS)).tolist()):
        chain[k], slot[place] = slot[place], k
    letters = np.zeros(_LITERAL_GAP + 1, bool)
    letters[np.frombuffer("".join(pieces[i] for i in normal).encode("utf-32-le"), np.uint32)] = True
    start = np.concatenate([[0], np.cumsum([len(x) for x in text])])
    return Model(weight, hashes, np.array(list(entry.values())), slot, chain, int(length.max()), letters, byte_id, np.frombuffer(b"".join(text), np.uint8), start, float(weight[normal].min()) - _BACK)


class Lattice(NamedTuple):
    """Distinct chunks of a slice: arcs by place, and the chunks of the texts in order.

    ``arc``: first arc of each place, arcs of longer pieces first; ``to``: place
    reached (-1: chunk end); ``piece``: id, or -1 - code point for one that goes
    through its bytes; ``logp``: log-probability given the place; ``cum``:
    probability of the place's arcs up to and with this one.
    """

    arc: np.ndarray
    to: np.ndarray
    piece: np.ndarray
    logp: np.ndarray
    cum: np.ndarray
    chunk: np.ndarray
    row: np.ndarray


def _utf8_length(code: np.ndarray) -> np.ndarray:
    code = np.where(code == _LITERAL_GAP, _GAP, code)
    return 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with a space in front if not empty; rows of the code points."""
    size = np.array([len(x) + 1 if x else 0 for x in texts], np.int64)
    code = np.frombuffer("".join(" " + x for x in texts if x).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code = np.where(code == _GAP, _LITERAL_GAP, code)
    code[code == 32] = _GAP
    return code, np.repeat(np.arange(len(texts)), size)


def lattice(texts: list[str | None], model: Model) -> Lattice:
    code, row = _codes(texts)
    n = len(code)
    if not n:
        none = np.zeros(0, np.int64)
        return Lattice(np.zeros(1, np.int64), none, none, np.zeros(0), np.zeros(0), none, none)
    gap = code == _GAP
    spelt = model.letters[code]
    head = np.ones(n, bool)
    head[1:] = (gap[1:] & ~gap[:-1]) | ~spelt[1:] | ~spelt[:-1] | (row[1:] != row[:-1])
    start = np.flatnonzero(head)
    end = np.append(start[1:], n)
    h = _span_hash(code, start, end)
    _, pick, chunk = np.unique(h, return_index=True, return_inverse=True)
    size = (end - start)[pick]
    base = np.concatenate([[0], np.cumsum(size)])
    m = base[-1]
    owner = np.repeat(np.arange(len(pick)), size)
    place = np.arange(m)
    own = code[place - base[owner] + start[pick][owner]]
    rest = base[owner + 1] - place
    total = np.zeros(m + 1, np.uint64)
    np.cumsum(_code_hash(own) * ts._power("inverse", ts._INVERSE, m), out=total[1:])
    power = ts._power("base", ts._BASE, m)
    at, length, piece = [], [], []
    single = np.zeros(m, bool)
    here, begun = place, np.zeros(m, np.int16)
    for size_of in range(1, model.longest + 1):
        here = here[(rest[here] >= size_of) & (begun[here] == size_of - 1)]
        if not len(here):
            break
        h = ts.mix((total[here + size_of] - total[here]) * power[here] ^ _LENGTHS[size_of])
        k = model.slot[h >> np.uint64(64 - _SLOT_BITS)]
        among = np.flatnonzero(k >= 0)
        k = k[among]
        while len(among):
            right = model.hashes[k] == h[among]
            begun[here[among[right]]] = size_of
            right_id = model.ids[k[right]]
            hit = here[among[right]][right_id >= 0]
            at.append(hit)
            piece.append(right_id[right_id >= 0])
            length.append(np.full(len(hit), size_of))
            if size_of == 1:
                single[hit] = True
            k, among = model.chain[k[~right]], among[~right]
            k, among = k[k >= 0], among[k >= 0]
    alone = np.flatnonzero(~single)
    at.append(alone)
    piece.append(-1 - own[alone])
    length.append(np.ones(len(alone), np.int64))
    # Longest pieces first, so that a stable sort by place leaves the likeliest arc of a place in front.
    at, piece, length = (np.concatenate(x[::-1]) for x in (at, piece, length))
    order = np.argsort(at, kind="stable")
    at, piece, length = at[order], piece[order], length[order]
    weight = np.where(piece >= 0, model.weight[np.maximum(piece, 0)], 0.0)
    back = piece < 0
    weight[back] = model.back * _utf8_length(-1 - piece[back])
    beta = np.zeros(m + 1)
    to = np.where(length == rest[at], m, at + length)
    far = rest[at]
    order = np.argsort(far.astype(np.uint16) if far.max() < 65536 else far, kind="stable")  # groups by distance from the chunk's end need only groups before
    by_at, by_weight, by_to = at[order], weight[order], to[order]
    firsts = np.flatnonzero(np.append(True, by_at[1:] != by_at[:-1]))
    groups = np.flatnonzero(np.append(True, np.diff(rest[by_at[firsts]]) > 0))
    for a, b in zip(groups, np.append(groups[1:], len(firsts))):
        lo, hi = firsts[a], firsts[b] if b < len(firsts) else len(at)
        beta[by_at[firsts[a:b]]] = np.logaddexp.reduceat(by_weight[lo:hi] + beta[by_to[lo:hi]], firsts[a:b] - lo)
    logp = np.minimum(weight + beta[to] - beta[at], 0.0)
    arc = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=m))])
    p = np.exp(logp)
    run = np.cumsum(p)
    cum = run - np.append(0.0, run)[arc[at]]
    cum[arc[1:] - 1] = 1.0
    return Lattice(arc, np.where(to == m, -1, to), piece, logp, cum, base[:-1][chunk], row[start])


def _unit(h: np.ndarray) -> np.ndarray:
    """Number strictly between 0 and 1."""
    return ((h >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def walk(lat: Lattice, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Walk every chunk from its node to its end by fresh draws; (chunk number, arc, draw) in order of chunk and step."""
    live, who, arcs, draws, step = node.copy(), np.arange(len(node)), [], [], 0
    on = np.flatnonzero(live >= 0)
    live, who = live[on], who[on]
    owners = []
    while len(live):
        step += 1
        h = ts.mix(seed[who] + _STEPS[step % len(_STEPS)] + np.uint64(step // len(_STEPS)))
        u, arc = _unit(h), lat.arc[live]
        over = np.flatnonzero(lat.cum[arc] < u)
        while len(over):
            arc[over] += 1
            over = over[lat.cum[arc[over]] < u[over]]
        owners.append(who)
        arcs.append(arc)
        draws.append(h)
        live = lat.to[arc]
        on = live >= 0
        live, who = live[on], who[on]
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return owner[order], np.concatenate(arcs)[order], np.concatenate(draws)[order]


def below(location: np.ndarray, limit: np.ndarray | float, h: np.ndarray) -> np.ndarray:
    """Gumbel variables of a location, given that they lie under a limit."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(np.isneginf(location), -np.inf, location - np.log(np.exp(np.minimum(location - limit, 700)) - np.log(_unit(ts.mix(h + _K[0])))))


class _Search:
    """Search state of one text: its found segmentations and the keys of what they left."""

    __slots__ = ("paths", "chunks", "phi", "keys", "keyed", "tops", "gone", "first", "scores")

    def __init__(self) -> None:
        self.paths, self.chunks, self.phi, self.keys, self.keyed, self.tops = [], [], [], [], [], []
        self.gone: dict[tuple[int, int], list[int]] = {}
        self.scores: list[tuple[float, float]] = []

    def add(self, arcs, chunk, phi, keys, key, new_from) -> None:
        """A completed segmentation, its running log-probabilities and the keys of what its new part left."""
        self.paths.append(arcs)
        self.chunks.append(chunk)
        self.phi.append(phi)
        self.keys.append(keys)
        self.keyed.append(new_from)
        self.tops.append(keys.max(initial=-np.inf))
        self.scores.append((phi[-1], key))


def sample(texts: list[str | None], seeds: np.ndarray, model: Model, k: int = SAMPLES) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """Per text its samples: (piece ids, log-probability, perturbed value, log of the inclusion score)."""
    lat = lattice(texts, model)
    with np.errstate(divide="ignore"):
        others = np.log(-np.expm1(lat.logp))
    others[np.repeat(np.diff(lat.arc) == 1, np.diff(lat.arc))] = -np.inf
    n = len(texts)
    edge = np.searchsorted(lat.row, np.arange(n + 1))
    number = np.arange(len(lat.chunk)) - edge[lat.row] if len(lat.row) else np.zeros(0, np.int64)
    row_seed = ts.mix(seeds.astype(np.uint64) * _K[0] + np.uint64(SEED))
    place_seed = lambda rows, numbers, s: ts.mix(ts.mix(row_seed[rows] + np.uint64(s)) + numbers.astype(np.uint64) * _K[2])
    searches = [_Search() for _ in range(n)]
    owner, arcs, draws = walk(lat, lat.chunk, place_seed(lat.row, number, 0))
    cut = np.searchsorted(owner, edge)
    logp, mass = lat.logp[arcs], others[arcs]
    top = -np.log(-np.log(_unit(ts.mix(row_seed + _K[3]))))
    row_of = np.repeat(np.arange(n), np.diff(cut))
    run = np.concatenate([[0.0], np.cumsum(logp)])
    keys = below(run[:-1] - run[cut[:-1]][row_of] + mass, top[row_of], draws)
    for i in range(n):
        a, b = cut[i], cut[i + 1]
        searches[i].add(arcs[a:b], owner[a:b], run[a:b + 1] - run[a], keys[a:b], top[i], 0)
    for s in range(1, k):
        # Every text takes its best node; the walks of all texts then go on in step.
        found = []
        for i, x in enumerate(searches):
            t = int(np.argmax(x.tops))
            if len(x.paths) < s or x.tops[t] == -np.inf:
                continue
            j = int(np.argmax(x.keys[t]))
            found.append((i, t, j, x.keyed[t] + j, x.keys[t][j]))
        if not found:
            break
        who, steps, limits = (np.array([f[c] for f in found]) for c in (0, 3, 4))
        arc = np.array([searches[i].paths[t][step] for i, t, _, step, _ in found])
        chunk = np.array([searches[i].chunks[t][step] for i, t, _, step, _ in found])
        place = np.searchsorted(lat.arc, arc, "right") - 1
        h = ts.mix(ts.mix(row_seed[who] ^ _K[1]) + np.uint64(s * 2**40) + steps.astype(np.uint64))
        u, taken, rest, nodes = _unit(h), np.empty(len(found), np.int64), np.zeros(len(found)), []
        for f, (i, t, j, step, _) in enumerate(found):
            gone = searches[i].gone.setdefault((t, step), [int(arc[f])])
            left = [e for e in range(lat.arc[place[f]], lat.arc[place[f] + 1]) if e not in gone]
            p = np.exp(lat.logp[left])
            taken[f] = left[min(int(np.searchsorted(np.cumsum(p), u[f] * p.sum())), len(left) - 1)]
            gone.append(int(taken[f]))
            rest[f] = p.sum() - np.exp(lat.logp[taken[f]]) if len(left) > 1 else 0.0
            nodes.append(lat.chunk[chunk[f]:edge[i + 1]])
        ends = np.cumsum([len(x) for x in nodes])
        firsts = ends - [len(x) for x in nodes]
        nodes = np.concatenate(nodes)
        nodes[firsts] = lat.to[taken]
        many = np.diff(np.append(firsts, len(nodes)))
        rows, chunks = np.repeat(who, many), np.arange(len(nodes)) + np.repeat(chunk - firsts, many)
        owner, arcs, draws = walk(lat, nodes, place_seed(rows, number[chunks], s))
        cut = np.searchsorted(owner, np.append(0, ends))
        before = np.array([searches[i].phi[t][step] for i, t, _, step, _ in found])
        with np.errstate(divide="ignore"):
            kept = below(before + np.log(np.maximum(rest, 0.0)), limits, ts.mix(h + _K[2]))
        logp, begun = lat.logp[arcs], before + lat.logp[taken]
        phis = [np.cumsum(np.append(begun[f], logp[a:b])) for f, (a, b) in enumerate(zip(cut, cut[1:]))]
        fresh = below(np.concatenate([x[:-1] for x in phis]) + others[arcs], np.repeat(limits, np.diff(cut)), draws)
        owners = chunks[owner]
        for f, (i, t, j, step, key) in enumerate(found):
            x, a, b = searches[i], cut[f], cut[f + 1]
            x.keys[t][j] = kept[f]
            x.tops[t] = x.keys[t].max()
            x.add(np.concatenate([x.paths[t][:step], [taken[f]], arcs[a:b]]), np.concatenate([x.chunks[t][:step], [chunk[f]], owners[a:b]]),
                  np.concatenate([x.phi[t][:step + 1], phis[f]]), fresh[a:b], key, step + 1)
    flat, ends = _ids(lat.piece, [p for x in searches for p in x.paths], model)
    out, at = [], 0
    for x in searches:
        limit, own = max(x.tops), []
        for phi, key in x.scores:
            far = phi - limit
            own.append((flat[ends[at]:ends[at + 1]], float(phi), float(key), float(np.log(-np.expm1(-np.exp(min(far, 700))))) if far > -30 else float(far)))
            at += 1
        out.append(own)
    return out


def _ids(piece: np.ndarray, paths: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of all paths, one after the other, with their ends; code points without a piece become their bytes."""
    ends = np.concatenate([[0], np.cumsum([len(p) for p in paths])])
    found = piece[np.concatenate(paths)] if ends[-1] else np.zeros(0, np.int64)
    byted = np.flatnonzero(found < 0)
    if not len(byted):
        return found.astype(np.int32), ends
    size = np.ones(len(found), np.int64)
    code = -1 - found[byted]
    size[byted] = _utf8_length(code)
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(at[-1], np.int32)
    out[at[:-1]] = found
    for c in np.unique(code):
        for k, byte in enumerate(chr(_GAP if c == _LITERAL_GAP else c).encode()):
            out[at[byted[code == c]] + k] = model.byte_id[byte]
    return out, at[ends]


def decoded(ids: np.ndarray, offsets: np.ndarray, model: Model) -> ts.Texts:
    """Texts of consecutive rows of ids, as UTF-8; the space in front of every text is taken off."""
    size = model.start[ids + 1] - model.start[ids]
    at = np.concatenate([[0], np.cumsum(size)])
    data = model.data[np.arange(at[-1]) + np.repeat(model.start[ids] - at[:-1], size)]
    edges = at[offsets]
    keep = np.ones(len(data), bool)
    keep[edges[:-1][edges[1:] > edges[:-1]]] = False
    return ts.Texts(data[keep], ts.running(keep)[edges].astype(np.int64))


ENCODED = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double, text_hash long"


def encode(docs: DataFrame, k: int = SAMPLES, path: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Up to k distinct segmentations of every row of ``docs``, best perturbed value first."""
    model = docs.sparkSession.sparkContext.broadcast(load(path))
    names = [c.split()[0] for c in ENCODED.split(", ")]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "text"):
            key = b.column("doc_id").fill_null(0).to_numpy().view(np.uint64)
            found = sample(b.column("text").to_pylist(), key, model.value, k)
            count = np.array([len(x) for x in found])
            at = np.repeat(np.arange(b.num_rows), count)
            flat = [y for x in found for y in x]
            ends = np.cumsum([0] + [len(y[0]) for y in flat]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([y[0] for y in flat]).astype(np.int32)))
            number = np.concatenate([np.arange(1, c + 1) for c in count]).astype(np.int32)
            values = [pa.array([float(y[j]) for y in flat]) for j in (1, 2, 3)]
            take = pa.array(at)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(take), pa.array(number), lists, *values, b.column("text_hash").take(take)], names)

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("text_hash"),
    ).mapInArrow(scan, ENCODED)


def decode(encoded: DataFrame, path: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the text of ``ids``; null ids give an empty text."""
    model = encoded.sparkSession.sparkContext.broadcast(load(path))
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                b = batch.slice(a, 256)
                lists = b.column(ids)
                size = np.array([len(x) if x.is_valid else 0 for x in lists], np.int64)
                t = decoded(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(size)]), model.value)
                text = pa.LargeStringArray.from_buffers(b.num_rows, pa.py_buffer(np.ascontiguousarray(t.offsets)), pa.py_buffer(np.ascontiguousarray(t.data)))
                yield pa.RecordBatch.from_arrays([*b.columns, text.cast(pa.string())], [*b.schema.names, out])

    return encoded.mapInArrow(scan, schema)
