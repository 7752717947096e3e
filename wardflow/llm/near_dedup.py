"""Near-duplicate classes by BagMinHash.

A text is the multiset of its runs of five words (all its words, if fewer).
Each element of the multiset carries Poisson processes over its weight axis,
one for every dyadic piece (0, 1], (1, 2], (2, 4], (4, 8], ... of the
discretised weights; a point has a time, a place on the weight axis and a
register.  A text sees the points whose place lies within its element's weight,
and a register of its signature is the point that comes first.  Texts that hold
the same element with other weights see the same points up to the smaller
weight, so registers agree with probability sum(min) / sum(max): the weighted
Jaccard similarity, without bias.  Only points before a time limit are made, the
limit being such that every register gets a point; texts with a register still
empty go on to twice the limit.

Texts with equal multisets form one node.  Nodes meet in buckets of equal bands
of registers; pairs are verified by the multiset overlap of their texts.  A
bucket is searched by leaders, not by pairs: first every node against the first
leader of its buckets, in one order of all nodes, then, only in buckets
that still hold several classes, the nodes outside the first leader's against the
next 4, 64, 1024, ... leaders, in an order of each bucket's own, until a bucket is one
class or all its nodes have led.  Before that, runs that only one of the texts still open holds bound its
similarity to all others: a text whose bound misses the threshold leaves the
search, and so does a pair.  The bound of a pair is taken part by part of the runs:
copies that each lack other runs of a common original lack them in other parts, so
what both hold is known almost exactly without comparing texts.  So no link between classes is lost within a bucket,
and a group of copies costs a few comparisons a node.  Two nodes with several equal
bands meet as leader and other only in the bucket of the first of them, and only while
the earlier one in its order leads (or a node of the first leader's class), so a pair is
formed once, not for each band and each of the two.

Cases: null and empty texts and those of white space only have an empty
multiset and form one class; rows with equal ids are one document and share a
class; a row without an id takes the class of a row with an equal multiset, else
null; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.segments import durable
from . import textscan as ts

WIDTH = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 24
REGISTERS = ROWS * BANDS
#: Pairs whose registers agree on fewer than this share are not verified: 6 standard errors under the threshold.
LEAST_AGREEMENT = 0.58
#: Runs are dealt by hash to so many parts; two texts share at most the sum of the smaller counts of each part.
PARTS = 64
#: Bytes of text taken at once: the points of a slice's runs are many times its size.
SLICE = ts.SLICE_BYTES
_ONE = np.uint64(1)


def elements(t: ts.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, element, weight) of every text's multiset, by row and element."""
    w = ts.words(t)
    h = ts.hashes(t.data, w)
    n = len(t.offsets) - 1
    at, run = ts.windows(h, w.row, WIDTH)
    row = w.row[at]
    short = np.flatnonzero((ts.per_row(w.row, n) < WIDTH)[w.row]) if len(h) else np.zeros(0, np.int64)
    if len(short):
        # A text of fewer words is one element: its words in order.
        rows, first = np.unique(w.row[short], return_index=True)
        whole = np.zeros(len(rows), np.uint64)
        for i, (a, b) in enumerate(zip(first, np.append(first[1:], len(short)))):
            for x in h[short[a:b]]:
                whole[i:i + 1] = ts.mix(whole[i:i + 1] * np.uint64(31) + x + _ONE)
        row, run = np.concatenate([row, rows]), np.concatenate([run, whole])
    order = np.lexsort((run, row))
    row, run = row[order], run[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    return row[head], run[head], np.diff(np.append(head, len(run)))


def _unit(h: np.ndarray) -> np.ndarray:
    """Number in (0, 1] from the upper bits of a hash."""
    return ((h >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """(n, m) registers; all zero for a row without elements."""
    out = np.zeros((n, m), np.uint64)
    total = np.bincount(row, weights=weight, minlength=n)
    limit = np.divide(m * (np.log(m) + 6), total, out=np.zeros(n), where=total > 0)
    todo = np.flatnonzero(total > 0)
    best = np.full(n * m, np.inf)
    while len(todo):
        active = np.zeros(n, bool)
        active[todo] = True
        pick = np.flatnonzero(active[row])
        best.reshape(n, m)[todo] = np.inf
        times, slots, marks = [], [], []
        piece, low = 0, 0
        while len(pick):
            high = 1 << piece
            seed = ts.mix(element[pick] ^ np.uint64((piece + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
            rate, clock, live, step = float(high - low), np.zeros(len(pick)), np.arange(len(pick)), 0
            while len(live):
                step += 1
                h = ts.mix(seed[live] + np.uint64(step * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF))
                clock[live] -= np.log(_unit(h)) / rate
                live = live[on] if not (on := clock[live] <= limit[row[pick[live]]]).all() else live
                h = ts.mix(h[on] ^ np.uint64(0xA0761D6478BD642F))
                place = low + _unit(ts.mix(h + _ONE)) * rate
                seen = place <= weight[pick[live]]
                hit = pick[live[seen]]
                times.append(clock[live[seen]])
                slots.append(row[hit] * m + (h[seen] % np.uint64(m)).astype(np.int64))
                marks.append(ts.mix(h[seen] ^ element[hit]))
            pick = pick[weight[pick] > high]
            low, piece = high, piece + 1
        time, slot, mark = np.concatenate(times), np.concatenate(slots), np.concatenate(marks)
        np.minimum.at(best, slot, time)
        first = time == best[slot]
        out.reshape(-1)[slot[first]] = mark[first]
        todo = todo[np.isinf(best.reshape(n, m)[todo]).any(axis=1)]
        limit[todo] *= 2
    return out


SIGNED = "doc_id long, bag long, bag2 long, n_runs long, bands array<long>, marks binary, parts array<int>"


def signed_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its multiset's 128-bit digest, size, band keys, one byte of each register and size by part."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "text", SLICE):
            n = b.num_rows
            row, element, weight = elements(ts.texts(b.column("text")))
            pair = ts.mix(element + ts.mix(weight.astype(np.uint64)))
            digest = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
            np.add.at(digest[0], row, pair)
            np.add.at(digest[1], row, ts.mix(pair ^ np.uint64(0xE7037ED1A0B428DB)))
            size = np.bincount(row, weights=weight, minlength=n).astype(np.int64)
            sig = signatures(row, element, weight, n)
            keys = np.zeros((n, BANDS), np.uint64)
            for r in range(ROWS):
                keys = ts.mix(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, r::ROWS])
            keys = ts.mix(keys + np.arange(BANDS, dtype=np.uint64))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), pa.array(keys.reshape(-1).view(np.int64)))
            marks = pa.array([x.tobytes() for x in (sig & np.uint64(255)).astype(np.uint8)], pa.binary())
            slot = row * PARTS + (element & np.uint64(PARTS - 1)).astype(np.int64)
            held = np.bincount(slot, weights=weight, minlength=n * PARTS).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * PARTS), pa.array(held))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *[pa.array(d.view(np.int64)) for d in digest], pa.array(size), bands, marks, parts],
                ["doc_id", "bag", "bag2", "n_runs", "bands", "marks", "parts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, SIGNED)


def first_common(a: Column, b: Column) -> Column:
    """Key of the first band that two nodes share."""
    return F.get(F.filter(F.zip_with(a, b, lambda x, y: F.when(x == y, x)), lambda k: k.isNotNull()), F.lit(0))


def buckets(nodes: DataFrame) -> DataFrame:
    """(key, node) of every band key that two nodes or more share."""
    keys = nodes.select(F.explode("bands").alias("key"), "node")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return keys.join(shared, "key")


def named_in(rows: DataFrame, key: str, pairs: DataFrame) -> DataFrame:
    """The rows whose ``key`` is in a pair (a, b); only these are sent to a join with the pairs."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct()
    return rows.join(ends, key, "left_semi")


def agreeing(pairs: DataFrame, nodes: DataFrame, least: float = LEAST_AGREEMENT) -> DataFrame:
    """The pairs whose registers agree often enough to be worth a comparison of texts.

    The pairs are written first: their size is known then, and few are sent to the
    rows they name instead of all rows to them.
    """
    pairs = durable(pairs)
    nodes = named_in(nodes, "node", pairs)
    marks = lambda c: nodes.select(F.col("node").alias(c), F.col("marks").alias(f"{c}_marks"))
    rows = pairs.join(marks("a"), "a").join(marks("b"), "b").select("a", "b", "a_marks", "b_marks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in ("a_marks", "b_marks"))
            yield b.select(["a", "b"]).filter(pa.array((x == y).mean(axis=1) >= least))

    return rows.mapInArrow(compare, "a long, b long")


def overlap(a: ts.Texts, b: ts.Texts) -> np.ndarray:
    """Weighted Jaccard similarity of the texts in the same rows; 1 for two empty multisets."""
    n = len(a.offsets) - 1
    one, two = elements(a), elements(b)
    row, run, weight = (np.concatenate(x) for x in zip(one, two))
    order = np.lexsort((run, row))
    row, run, weight = row[order], run[order], weight[order]
    same = np.flatnonzero((row[1:] == row[:-1]) & (run[1:] == run[:-1])) if len(row) else np.zeros(0, np.int64)
    both = np.bincount(row[same], weights=np.minimum(weight[same], weight[same + 1]), minlength=n)
    either = np.bincount(row, weights=weight, minlength=n) - both
    return np.divide(both, either, out=np.ones(n), where=either > 0)


def verified(pairs: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs of documents (a, b) whose texts are similar enough; ``docs`` has (doc_id, text)."""
    pairs = durable(pairs)
    docs = named_in(docs.select("doc_id", "text"), "doc_id", pairs)
    text = lambda c: docs.select(F.col("doc_id").alias(c), F.col("text").alias(f"{c}_text"))
    rows = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "a_text", "b_text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "a_text", SLICE):
            like = overlap(ts.texts(b.column("a_text")), ts.texts(b.column("b_text")))
            yield b.select(["a", "b"]).filter(pa.array(like >= threshold - 1e-12))

    return rows.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge (a, b): the smallest node it is linked to in any number of steps.

    Every step takes the least label around a node and then that label's own
    label; each is written as a table, so a lost executor costs one step.
    """
    both = durable(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near.withColumnRenamed("a", "node"), "node").select("node", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("far"))
        step = durable(least.join(jump, "new", "left").select("node", "label", F.least("new", F.coalesce("far", "new")).alias("next")))
        done = step.where("next < label").isEmpty()
        labels = step.select("node", F.col("next").alias("label"))
        if done:
            return labels


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, label) after more edges: only the labels that they link are looked through again.

    A label is the smallest node of its class, so the components of the labels that the
    new edges link rename whole classes.
    """
    name = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    ends = edges.join(name("a"), "a", "left").join(name("b"), "b", "left").select(
        F.coalesce("a_label", "a").alias("a"), F.coalesce("b_label", "b").alias("b")).where("a <> b").distinct()
    moved = components(ends).select(F.col("node").alias("label"), F.col("label").alias("to"))
    # A node without an edge before is its own class.
    new = moved.select(F.col("label").alias("node")).join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label"))
    return durable(labels.unionByName(new).join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label")))


def open_buckets(held: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, node, class, first) of the buckets with nodes of several classes; ``first`` is the class of the first in order."""
    now = held.join(labels, "node", "left").select("key", "node", "turn", F.coalesce("label", "node").alias("class"))
    first = F.min(F.struct("turn", "node", "class"))["class"].alias("first")
    spread = now.groupBy("key").agg(F.min("class").alias("lo"), F.max("class").alias("hi"), first).where("lo < hi").select("key", "first")
    return now.join(spread, "key").select("key", "node", "class", "first")


def linkable(rest: DataFrame, nodes: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(key, node, turn, size, common) and (node, parts): the rows of ``rest`` (key, node) whose node may be similar to another of its bucket.

    Runs that no other of these texts holds are outside every overlap.  With s
    runs, c of them held elsewhere, the similarity to a text of t runs is at
    most c / (s + t - c); a node for which that misses the threshold even with
    the smallest text of its bucket has no link there.  Nothing else is left
    out, so no link is lost.  ``common`` and ``parts`` count the runs held elsewhere, in
    all and by part; ``parts`` is null for an id with several texts.
    """
    named = rest.select(F.col("node").alias("doc_id")).distinct()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in ts.sliced(batches, "text", SLICE):
            row, run, weight = elements(ts.texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(row)), pa.array(run.view(np.int64)), pa.array(weight.astype(np.int64))], ["node", "run", "weight"])

    runs = docs.select("doc_id", "text").join(named, "doc_id").mapInArrow(scan, "node long, run long, weight long")
    single = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight")).where("n = 1")
    by_part = single.groupBy("node", F.col("run").bitwiseAND(F.lit(PARTS - 1)).cast("int").alias("part")).agg(F.sum("weight").alias("own"))
    own = by_part.groupBy("node").agg(F.sum("own").alias("own"), F.map_from_entries(F.collect_list(F.struct("part", "own"))).alias("own_parts"))
    size = nodes.join(named.withColumnRenamed("doc_id", "node"), "node").groupBy("node").agg(
        F.min("n_runs").alias("size"), F.count(F.lit(1)).alias("rows"), F.first("parts").alias("parts"))
    elsewhere = F.transform("parts", lambda n, i: (n - F.coalesce(F.try_element_at("own_parts", i), F.lit(0))).cast("int"))
    # A node of several rows (one id, several texts) counts as wholly shared.
    alone = F.col("rows") == 1
    known = durable(size.join(own, "node", "left").select(
        "node", "size", F.when(alone, F.col("size") - F.coalesce("own", F.lit(0))).alias("common"), F.when(alone, elsewhere).alias("parts")))
    most = F.lit(1 << 40)
    rows = durable(rest.join(known.drop("parts"), "node").select("key", "node", F.when(F.col("common").isNull(), 0).otherwise(F.col("size")).alias("size"), F.coalesce("common", most).alias("common")))
    least = rows.groupBy("key").agg(F.min("size").alias("least"))
    may = (F.col("size") + F.col("least")) * threshold <= F.col("common") * (1 + threshold) + 1e-9
    return rows.join(least, "key").where(may).select("key", "node", F.xxhash64("key", "node").alias("turn"), "size", "common"), known.select("node", "parts")


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, n_runs), one row per row of ``docs``; a class is named by its smallest id."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    signed = durable(signed_texts(docs))
    bag = ["bag", "bag2", "n_runs"]
    names = signed.groupBy(*bag).agg(F.min("doc_id").alias("node"))
    member = signed.select("doc_id", *bag).join(names, bag).select("doc_id", "node", "n_runs")
    nodes = signed.join(names.where("n_runs > 0").select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "bands", "marks", "n_runs", "parts")
    held = durable(buckets(nodes).withColumn("turn", F.xxhash64("node")))  # one order, so the buckets of a group of near copies have few first leaders between them

    first = held.groupBy("key").agg(F.min(F.struct("turn", F.col("node").alias("a"))).alias("lead")).select("key", F.col("lead.a").alias("a"))
    pairs = held.join(first, "key").where("a <> node").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    edges = durable(verified(agreeing(pairs, nodes), docs, threshold))
    labels = components(edges)
    # Buckets that hold several classes after their first leader, without the nodes that can have no link in them.
    alone = held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n = 2").select("key")
    rest = durable(open_buckets(held.join(alone, "key", "left_anti"), labels).select("key", "node"))
    able, parts = linkable(rest, nodes, docs, threshold)
    held = durable(able)
    # An id with several texts has the bands of each; its pairs are formed in every bucket.
    bands = nodes.groupBy("node").agg(F.first("bands").alias("bands"), F.count(F.lit(1)).alias("texts")).select("node", F.when(F.col("texts") == 1, F.col("bands")).alias("bands"))
    held = durable(held.join(bands.join(parts, "node"), "node"))
    reaches = lambda most: (F.col("a_size") + F.col("b_size")) * threshold <= most * (1 + threshold) + 1e-9
    shared = F.aggregate(F.zip_with("a_parts", "b_parts", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda s, n: s + n)
    fits = reaches(F.least("a_common", "b_common")) & F.coalesce(reaches(shared), F.lit(True))
    once = F.coalesce(first_common(F.col("a_bands"), F.col("b_bands")) == F.col("b_key"), F.lit(True))
    led, more = 0, 4
    while True:
        left = durable(open_buckets(held, labels).join(held.select("key", "node", "size", "common", "turn", "bands", "parts"), ["key", "node"]))
        rank = F.row_number().over(Window.partitionBy("key").orderBy("turn", "node"))
        leaders = left.withColumn("rank", rank).where((F.col("rank") > led) & (F.col("rank") <= led + more)).select(
            "key", F.col("node").alias("a"), F.col("class").alias("a_class"), F.col("size").alias("a_size"), F.col("common").alias("a_common"), F.col("bands").alias("a_bands"),
            F.col("parts").alias("a_parts"), F.struct("turn", "node").alias("a_turn"), (F.col("class") == F.col("first")).alias("a_first"))
        if leaders.isEmpty():
            break
        # The first leader's class only grows; a pair of it and another class is met once its node of that class leads.
        others = left.where("class <> first").select(
            F.col("key").alias("b_key"), F.col("node").alias("b"), F.col("class").alias("b_class"), F.col("size").alias("b_size"), F.col("common").alias("b_common"), F.col("bands").alias("b_bands"),
            F.col("parts").alias("b_parts"), F.struct("turn", "node").alias("b_turn"))
        later = F.col("a_first") | (F.col("b_turn") > F.col("a_turn"))
        met = leaders.join(others, (F.col("key") == F.col("b_key")) & (F.col("a_class") != F.col("b_class")) & later & once & fits)
        pairs = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        # These pairs have met the bound part by part, which is closer than the registers.
        labels = joined(labels, durable(verified(pairs, docs, threshold)))
        led, more = led + more, more * 16
    return member.join(labels, "node", "left").select("doc_id", F.coalesce("label", "node").alias("class_id"), "n_runs")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their class, all columns as they were.

    Of rows with one id one stays; rows without an id stay.
    """
    found = durable(classes(docs, doc_id, text))
    lost = found.where("doc_id <> class_id").select("doc_id").distinct()
    again = found.where("doc_id = class_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    name = "class name"
    while name in map(str.lower, docs.columns):
        name += " "
    # The ids that go are fewer than those that stay; a null id is never among them.  They grow with the table, so they are not broadcast.
    keyed = lambda rows, how: docs.join(rows.select(F.col("doc_id").alias(name)).hint("merge"), F.col(doc_id).cast("long") == F.col(name), how)
    if again.isEmpty():
        return keyed(lost, "left_anti")
    return keyed(lost.unionByName(again), "left_anti").unionByName(keyed(again, "left_semi").dropDuplicates([doc_id]))
