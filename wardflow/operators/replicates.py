"""Bootstrap replicates as vectors.

A unit (person, prediction) carries one array with its number of draws in every
replicate, so tables keep their rows whatever the number of replicates.  Metrics of
all replicates come from one sweep over the rows in score order: a partition sums
arrays element by element and hands on one row per stratum, and a stratum's
partitions meet in their order as a stream.  Batches are cut so that a matrix of rows
by replicates stays small.

Cases: rows without draws in a replicate count nothing there; a replicate without any
weight has no value; a one-class replicate has the value of a metric that cannot be
computed; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.hashing import hash_int, key_hash
from ..functions.segments import durable, hash_rank

BLOCK = 1024
CELLS = 1 << 19
EPS = 1e-15
FAILED = -1.0
#: Metrics that one sweep gives for every replicate.
METRICS = ("auc", "brier", "loss_bce", "mean_prediction", "outcome_rate")
_LONGS, _DOUBLES = ArrayType(LongType()), ArrayType(DoubleType())


def _typed(df: DataFrame, keys: list[str], *more: tuple) -> StructType:
    return StructType([df.schema[k] for k in keys] + [StructField(n, t) for n, t in more])


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    step = max(1, CELLS // max(width, 1))
    for b in batches:
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _runs(b: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, int, int]]:
    """(key, first row, end) of the runs of equal keys in a sorted batch."""
    rows = list(zip(*(b.column(k).to_pylist() for k in keys))) if keys else [()] * b.num_rows
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i] != rows[start]:
            yield rows[start], start, i
            start = i


def _rows_out(schema: StructType, rows: list[tuple]) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)


def draw_vectors(df: DataFrame, n_boot: int, strata: list[str] = (), unit: str = "person_id", seed: int = 0) -> DataFrame:
    """(strata, unit, draws): exact draws with replacement per stratum, one array over all replicates.

    Units are ranked by hash; the j-th unit stands for the j-th draw and picks rank
    hash(replicate, stratum, j) modulo n in every replicate.  Picks travel packed, one
    row per task and block of ``BLOCK`` ranks, and are counted block by block.
    """
    strata = list(strata)
    units = df.select(*strata, unit).distinct()
    sizes = units.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n")) if strata else units.agg(F.count(F.lit(1)).alias("_n"))
    ranked = hash_rank(units, strata, key_hash(unit, seed=seed), "_rank")
    one = F.lit(1).alias("_one")
    ranked = durable(ranked.join(sizes, strata) if strata else ranked.select("*", one).join(F.broadcast(sizes.select("*", one)), "_one").drop("_one"))
    pick = lambda b: hash_int(b, *strata, "_rank", seed=seed) % F.col("_n")
    targets = ranked.select(*strata, F.transform(F.sequence(F.lit(0), F.lit(n_boot - 1)), pick).alias("targets"))
    packed = _typed(ranked, strata, ("_block", LongType()), ("picks", _LONGS))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, n_boot):
            keys = list(zip(*(b.column(k).to_pylist() for k in strata))) if strata else [()] * b.num_rows
            number = {k: i for i, k in enumerate(dict.fromkeys(keys))}
            owner = np.repeat(np.array([number[k] for k in keys], np.int64), n_boot)
            target = _matrix(b.column("targets"), n_boot)
            code = (target % BLOCK) * n_boot + np.arange(n_boot)
            target, code = target.reshape(-1) // BLOCK, code.reshape(-1)
            order = np.lexsort((target, owner))
            owner, target, code = owner[order], target[order], code[order]
            edge = np.flatnonzero(np.diff(owner, prepend=-1) | np.diff(target, prepend=-1))
            names = list(number)
            yield _rows_out(packed, [(*names[owner[a]], int(target[a]), code[a:z]) for a, z in zip(edge, np.append(edge[1:], len(code)))])

    counted = _typed(ranked, strata, ("_rank", LongType()), ("draws", ArrayType(IntegerType())))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None

        def done() -> pa.RecordBatch:
            used = np.flatnonzero(held.any(axis=1))
            return _rows_out(counted, [(*now[:-1], int(now[-1]) * BLOCK + int(i), held[i]) for i in used])

        for b in batches:
            for row in range(b.num_rows):
                key = tuple(b.column(k)[row].as_py() for k in [*strata, "_block"])
                if key != now:
                    if now is not None:
                        yield done()
                    now, held = key, np.zeros((BLOCK, n_boot), np.int32)
                held += np.bincount(b.column("picks")[row].values.to_numpy(), minlength=BLOCK * n_boot).reshape(BLOCK, n_boot).astype(np.int32)
        if now is not None:
            yield done()

    blocks = targets.mapInArrow(pack, packed).repartition(*strata, "_block").sortWithinPartitions(*strata, "_block")
    counts = blocks.mapInArrow(count, counted)
    return counts.join(ranked.select(*strata, unit, "_rank"), [*strata, "_rank"]).select(*strata, unit, "draws")


def with_draws(df: DataFrame, n_boot: int, strata: list[str] = (), unit: str = "person_id", seed: int = 0) -> DataFrame:
    """The rows with their unit's ``draws``."""
    return df.join(draw_vectors(df, n_boot, strata, unit, seed), [*strata, unit])


SUMS = ("pos", "neg", "wins", "brier", "loss", "score")


class _Sweep:
    """Sums over rows of one stratum in rising score order, an element per replicate."""

    def __init__(self, width: int) -> None:
        self.first: float | None = None
        self.sums = {k: np.zeros(width) for k in SUMS}
        self.open: tuple[float, np.ndarray, np.ndarray] | None = None

    def add(self, score: np.ndarray, label: np.ndarray, weight: np.ndarray, draws: np.ndarray) -> None:
        if self.first is None:
            self.first = float(score[0])
        s, w = self.sums, draws * weight[:, None]
        q = np.clip(score, EPS, 1 - EPS)
        s["brier"] += (w * ((score - label) ** 2)[:, None]).sum(axis=0)
        s["loss"] += (w * -np.where(label > 0, np.log(q), np.log1p(-q))[:, None]).sum(axis=0)
        s["score"] += (w * score[:, None]).sum(axis=0)
        edge = np.flatnonzero(np.diff(score, prepend=np.nan) != 0)
        pos, neg = (np.add.reduceat(w * y[:, None], edge, axis=0) for y in (label, 1 - label))
        values = score[edge]
        if self.open is not None:
            if self.open[0] == values[0]:
                pos[0] += self.open[1]
                neg[0] += self.open[2]
            else:
                self._close(self.open[1][None], self.open[2][None])
        self._close(pos[:-1], neg[:-1])
        self.open = values[-1], pos[-1], neg[-1]

    def _close(self, pos: np.ndarray, neg: np.ndarray) -> None:
        """Distinct scores that are complete: a positive wins against lower negatives and half of equal ones."""
        s = self.sums
        below = s["neg"] + np.cumsum(neg, axis=0) - neg
        s["wins"] += (pos * (below + neg / 2)).sum(axis=0)
        s["pos"] += pos.sum(axis=0)
        s["neg"] += neg.sum(axis=0)

    def finish(self) -> list[np.ndarray]:
        if self.open is not None:
            self._close(self.open[1][None], self.open[2][None])
        return [self.sums[k] for k in SUMS]


def replicate_metrics(df: DataFrame, strata: list[str], n_boot: int, weight: str | None = None, metrics=METRICS, label: str = "labels", score: str = "pred_probs") -> DataFrame:
    """(strata, metric, boot_id, performance) from rows with ``draws``.

    All replicates share one sort by score.  Equal scores of a stratum share a
    partition, so a stratum's partitions are joined by adding, for each, its positives
    times the negatives before it.
    """
    strata, unknown = list(strata), [m for m in metrics if m not in METRICS]
    if unknown:
        raise KeyError(f"no replicate vectors for {unknown}")
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.select(*strata, F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"), w.alias("_w"), "draws")
    pieces = _typed(df, strata, ("_first", DoubleType()), *[(k, _DOUBLES) for k in SUMS])

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in _slices(batches, n_boot):
            s, y, w_ = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_s", "_y", "_w"))
            draws = _matrix(b.column("draws"), n_boot)
            for key, a, z in _runs(b, strata):
                if held is None or key != now:
                    if held is not None:
                        yield _rows_out(pieces, [(*now, held.first, *held.finish())])
                    now, held = key, _Sweep(n_boot)
                held.add(s[a:z], y[a:z], w_[a:z], draws[a:z])
        if held is not None:
            yield _rows_out(pieces, [(*now, held.first, *held.finish())])

    found = _typed(df, strata, ("metric", StringType()), ("values", _DOUBLES))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def done() -> pa.RecordBatch:
            all_ = total["pos"] + total["neg"]
            share = lambda x: np.divide(x, all_, out=np.full(n_boot, np.nan), where=all_ > 0)
            both = total["pos"] * total["neg"]
            auc = np.divide(total["wins"], both, out=np.where(all_ > 0, FAILED, np.nan), where=both > 0)
            value = {"auc": auc, "brier": share(total["brier"]), "loss_bce": share(total["loss"]), "mean_prediction": share(total["score"]), "outcome_rate": share(total["pos"])}
            return _rows_out(found, [(*now, m, value[m]) for m in metrics])

        for b in batches:
            for i in range(b.num_rows):
                key = tuple(b.column(k)[i].as_py() for k in strata)
                part = {k: b.column(k)[i].values.to_numpy() for k in SUMS}
                if total is None or key != now:
                    if total is not None:
                        yield done()
                    now, total = key, {k: np.zeros(n_boot) for k in SUMS}
                total["wins"] = total["wins"] + part["pos"] * total["neg"]
                for k in SUMS:
                    total[k] = total[k] + part[k]
        if total is not None:
            yield done()

    swept = rows.repartitionByRange(*strata, "_s").sortWithinPartitions(*strata, "_s").mapInArrow(sweep, pieces)
    swept = swept.repartition(*strata) if strata else swept.repartition(1)  # one row per partition
    wide = swept.sortWithinPartitions(*strata, "_first").mapInArrow(join, found)
    long = wide.select(*strata, "metric", F.posexplode("values").alias("boot_id", "performance"))
    return long.where(~F.isnan("performance"))


FIT = (("a", _DOUBLES), ("b", _DOUBLES), ("status", ArrayType(StringType())))
_STATE = ("a", "b", "da", "db", "t", "ll")
_PARTS = ("weight", "ll", "ga", "gb", "haa", "hab", "hbb")
CONVERGED, OPEN = "converged", "open"


def newton(a: dict[str, np.ndarray], s: dict[str, np.ndarray], status: np.ndarray, tolerance: float) -> None:
    """One damped Newton step of every open fit, in place.

    ``a`` holds the last accepted point, the step from it, its part ``t`` that was tried and the likelihood;
    ``s`` the sums at the point tried.  A step that lowers the likelihood is halved.
    """
    open_ = status == OPEN
    status[open_ & (s["weight"] <= 0)] = "empty"
    open_ = status == OPEN
    worse = open_ & ~(s["ll"] >= a["ll"] - 1e-12 * (np.abs(a["ll"]) + 1e-3 * s["weight"]))
    status[worse & (a["t"] < 1e-6)] = "stuck"
    a["t"] = np.where(worse, a["t"] / 2, a["t"])
    better = open_ & ~worse
    gain = s["ll"] - a["ll"]
    small = np.maximum(np.abs(a["da"]), np.abs(a["db"])) * a["t"]
    a["a"], a["b"] = (np.where(better, a[p] + a["t"] * a[f"d{p}"], a[p]) for p in "ab")
    a["ll"] = np.where(better, s["ll"], a["ll"])
    det = s["haa"] * s["hbb"] - s["hab"] ** 2
    # Relative to the diagonal: 0 where all scores are equal, whatever their scale and number.
    flat = better & (det <= 1e-10 * s["haa"] * s["hbb"])
    with np.errstate(all="ignore"):
        da = np.where(flat, s["ga"] / s["haa"], (s["hbb"] * s["ga"] - s["hab"] * s["gb"]) / det)
        db = np.where(flat, 0.0, (s["haa"] * s["gb"] - s["hab"] * s["ga"]) / det)
    lost = better & ~(np.isfinite(da) & np.isfinite(db))
    status[better & (s["ll"] >= -1e-7 * s["weight"])] = "separable"
    status[lost & (status == OPEN)] = "separable"
    move = np.maximum(np.abs(da) / (1 + np.abs(a["a"])), np.abs(db) / (1 + np.abs(a["b"])))
    still = better & (status == OPEN) & (move <= tolerance)
    status[still] = np.where(flat[still], "constant", CONVERGED)
    # The likelihood no longer rises although the steps stay large: the optimum lies at infinity.
    status[better & (status == OPEN) & (gain <= 1e-13 * s["weight"]) & (small > 1e-3)] = "separable"
    go = better & (status == OPEN)
    a["da"], a["db"], a["t"] = np.where(go, da, a["da"]), np.where(go, db, a["db"]), np.where(go, 1.0, a["t"])


def logistic_vectors(rows: DataFrame, strata: list[str], n_boot: int = 1, tolerance: float = 1e-9) -> DataFrame:
    """(strata, a, b, status): unpenalised logistic fits of all strata and replicates in one loop.

    ``rows`` has x, w (weight), y (weight of positives) and ``draws``.  A step is one
    pass over the rows of the strata that are still open: sums of gradient, curvature and
    likelihood per stratum and replicate, then the damped step on those small rows, which
    are written.  Only the number of open strata comes back to the driver.  Every step
    raises a likelihood that is at most 0, or ends the fit: ``converged``, ``constant``
    (all x equal: a is fitted with b 0), ``separable`` (no finite optimum), ``stuck`` or
    ``empty``.
    """
    strata = list(strata)
    keys = strata or ["_all"]
    rows = durable((rows if strata else rows.withColumn("_all", F.lit("all"))).select(*keys, "x", "w", "y", "draws"))
    partial = _typed(rows, keys, *[(p, _DOUBLES) for p in _PARTS])
    state = _typed(rows, keys, *[(p, _DOUBLES) for p in _STATE], FIT[2])
    vector = lambda v: F.array_repeat(F.lit(v), n_boot)
    start = {"a": 0.0, "b": 0.0, "da": 0.0, "db": 0.0, "t": 1.0, "ll": float("-inf")}
    now = durable(rows.select(*keys).distinct().select(*keys, *[vector(start[p]).alias(p) for p in _STATE], vector(OPEN).alias("status")))
    done = None

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[np.ndarray]] = {}
        for b in _slices(batches, n_boot):
            names = list(zip(*(b.column(k).to_pylist() for k in keys)))
            number = {k: i for i, k in enumerate(dict.fromkeys(names))}
            owner = np.array([number[k] for k in names])
            x, w, y = (b.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("x", "w", "y"))
            draws, a, d = _matrix(b.column("draws"), n_boot), _matrix(b.column("ta"), n_boot), _matrix(b.column("tb"), n_boot)
            eta = a + d * x
            p = 0.5 * (1 + np.tanh(eta / 2))
            w, y = w * draws, y * draws
            h = w * p * (1 - p)
            g = y - w * p
            parts = (w, y * eta - w * np.logaddexp(0, eta), g, g * x, h, h * x, h * x * x)
            for key, i in number.items():
                mine = owner == i
                sums = [q[mine].sum(axis=0) for q in parts]
                held[key] = [u + v for u, v in zip(held[key], sums)] if key in held else sums
            if len(held) * n_boot > CELLS:
                yield _rows_out(partial, [(*k, *v) for k, v in held.items()])
                held = {}
        if held:
            yield _rows_out(partial, [(*k, *v) for k, v in held.items()])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, a, status, sums = None, None, None, None

        def finish() -> pa.RecordBatch:
            newton(a, sums, status, tolerance)
            return _rows_out(state, [(*key, *[a[p] for p in _STATE], status.tolist())])

        for b in batches:
            for i in range(b.num_rows):
                k = tuple(b.column(c)[i].as_py() for c in keys)
                if k != key:
                    if key is not None:
                        yield finish()
                    key, sums = k, {p: np.zeros(n_boot) for p in _PARTS}
                if b.column("status")[i].is_valid:
                    a = {p: np.array(b.column(p)[i].values.to_numpy()) for p in ("a", "b", "da", "db", "t")} | {"ll": np.array(b.column("ll0")[i].values.to_numpy())}
                    status = np.array(b.column("status")[i].as_py(), dtype=object)
                else:
                    sums = {p: sums[p] + b.column(p)[i].values.to_numpy() for p in _PARTS}
        if key is not None:
            yield finish()

    while True:
        tried = lambda p: F.zip_with(F.zip_with(f"d{p}", "t", lambda d, t: d * t), p, lambda d, v: v + d).alias(f"t{p}")
        part = rows.join(now.select(*keys, tried("a"), tried("b")), keys).mapInArrow(look, partial)
        both = now.withColumnRenamed("ll", "ll0").unionByName(part, allowMissingColumns=True)
        # State rows have a status and sort last.
        moved = durable(both.repartition(*keys).sortWithinPartitions(*keys, F.col("status").isNotNull()).mapInArrow(step, state))
        open_ = F.array_contains("status", OPEN)
        ended = moved.where(~open_).select(*keys, "a", "b", "status")
        done = ended if done is None else done.unionByName(ended)
        now = moved.where(open_)
        if now.isEmpty():
            return done if strata else done.drop("_all")
