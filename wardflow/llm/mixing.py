"""Mixing to target weights with soft domain membership.

A table of labels names the domain of some documents: ``toxic``, ``low`` quality
or ``good``.  A naive Bayes classifier over the presence of words and of style
marks learns from at most ``FIT_ROWS`` labelled documents and gives every
document a probability of each domain.  Document rates r >= 0 are then fitted by
projected gradient least squares, so that the expected tokens of a domain,
sum over documents of r * tokens * probability, match the targets.  The targets
are weights; the good domain's tokens in the input set the total, so that good
documents keep a rate near 1.

Features are the ``FEATURES`` words and marks that tell a domain from the good one
best; a domain's frequencies are smoothed by ``PRIOR_ROWS`` documents of the good
domain, so few labels make weak features, not none.  More features would tell apart
more at the price of more work per document; the bound does not depend on the input.

A step lowers a document's rate by the probability-weighted residuals and cuts it
at 0 (projection and gradient in the metric that weighs a document by its
tokens), from a point carried on along the last move; where the residuals rise, the
carrying starts anew.  A rate is therefore a short fold over the residuals of the
steps so far: one step is one aggregation over the table of probabilities, and only
a few numbers come back to the driver; every ``STORE_STEPS`` steps the rates are
stored.  The fit ends when the residuals are small ("met") or when the rates no
longer move, which is the least squares' optimum ("unreachable": the targets cannot
be met with these documents); after ``most_steps`` it says "unfinished".

All steps are SQL expressions.  Broadcast are the sampled ids (``FIT_ROWS`` at most);
the ``FEATURES`` chosen words are literals.

Cases: a null or empty text has no tokens, no words and the prior's
probabilities; with no labels every document is good with rate 1; labels that
repeat an id count once, as toxic if one says so, else as low if one says so;
labels without an id, or without a label, are not read; repeated rows each give
their own row; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.segments import durable

DOMAINS = ("good", "low", "toxic")
TARGETS = {"good": 0.95, "low": 0.04, "toxic": 0.01}
FIT_ROWS = 8000
FEATURES = 256
PRIOR_ROWS = 4.0
TOLERANCE = 1e-3
#: Token-weighted root mean square move of the rates in one step that counts as none.
STILL = 1e-5
STORE_STEPS = 16
MOST_STEPS = 1000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SYMBOLS = "#*$%&|<>"


def tokens(text: Column) -> Column:
    """Lower-cased words without the usual punctuation."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s.,!?;:|]+"), "")


def marks(text: Column, words: Column) -> Column:
    """Style marks: binned shares of symbols, capitals and distinct words; ``\\t`` keeps them apart from words."""
    whole = F.coalesce(text, F.lit(""))
    size = F.length(whole)
    share = lambda chars: F.floor(F.least((size - F.length(F.translate(whole, chars, ""))) / F.greatest(size, F.lit(1)) * 20, F.lit(6)))
    fresh = F.floor(F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)) * 10)
    long = F.floor(F.log2(F.size(words) + 1) / 2)
    return F.array(F.concat(F.lit("\tsymbols"), share(_SYMBOLS)), F.concat(F.lit("\tcapitals"), share(_UPPER)), F.concat(F.lit("\tfresh"), long, F.lit("_"), fresh))


def read(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_words`` and ``_marks``, each computed once per row."""
    value = F.col(text).cast("string")
    return docs.withColumn("_words", tokens(value)).withColumn("_marks", marks(value, F.col("_words")))


def domain_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents, one row per id."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    name = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), "good")
    return known.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("domain")).where("domain IS NOT NULL")


class Classifier(NamedTuple):
    """Chosen features, their weight when present by domain, and the weight of none present."""

    features: tuple[str, ...]
    present: tuple[tuple[float, ...], ...]
    base: tuple[float, ...]


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Classifier:
    """Fit on at most ``FIT_ROWS`` labelled documents, those whose ids hash lowest."""
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
    sample = domain_of(labels).join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(durable(sample)), "doc_id")
    rows = durable(read(rows).select("domain", F.concat(F.array_distinct("_words"), "_marks").alias("seen")))
    n = {r.domain: r.n for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    n = [n.get(d, 0) for d in DOMAINS]
    if not sum(n):
        return Classifier((), (), tuple(0.0 if i == 0 else -math.inf for i in range(len(DOMAINS))))
    counts = rows.select("domain", F.explode("seen").alias("feature")).groupBy("feature").agg(*[F.count_if(F.col("domain") == d).alias(d) for d in DOMAINS])
    # Frequencies smoothed towards the good domain's; a feature's worth is its part of the divergence from that domain.
    good = (F.col("good") + 0.5) / F.lit(n[0] + 1.0)
    rate = {d: (F.col(d) + PRIOR_ROWS * good) / F.lit(c + PRIOR_ROWS) for d, c in zip(DOMAINS, n)}
    worth = F.greatest(*[F.when(rate[d] > good, (rate[d] - good) * F.log(rate[d] / good)).otherwise(0.0) for d in DOMAINS[1:]])
    top = counts.select("*", worth.alias("worth"), *[rate[d].alias(f"p_{d}") for d in DOMAINS]).where("worth > 0").orderBy(F.desc("worth"), "feature").limit(FEATURES).collect()
    p = np.clip(np.array([[r[f"p_{d}"] for d in DOMAINS] for r in top]).reshape(-1, len(DOMAINS)), 1e-9, 1 - 1e-9)
    prior = np.log([(c + 0.1) / (sum(n) + 0.1 * len(DOMAINS)) for c in n])
    return Classifier(tuple(r.feature for r in top), tuple(map(tuple, (np.log(p) - np.log1p(-p)).tolist())), tuple((prior + np.log1p(-p).sum(axis=0)).tolist()))


def membership(model: Classifier) -> tuple[Column, Column]:
    """(number of tokens, array of domain probabilities) of a row with ``_words`` and ``_marks``.

    Naive Bayes over presence and absence: ``base`` holds the prior with all
    features absent, every feature found adds its weight.
    """
    count = F.size("_words").cast("long")
    if model.base[1] == -math.inf:
        return count, F.array(*[F.lit(1.0 if b == 0 else 0.0) for b in model.base])
    words, styles = (tuple(f for f in model.features if f.startswith("\t") == style) for style in (False, True))
    listed = lambda names: F.array(*[F.lit(f) for f in names]) if names else F.array().cast("array<string>")
    held = F.concat(F.array_intersect("_words", listed(words)), F.array_intersect("_marks", listed(styles)))
    at = F.transform(held, lambda x: F.array_position(listed(model.features), x).cast("int"))
    columns = [F.array(*[F.lit(row[k]) for row in model.present]) if model.present else F.array(F.lit(0.0)) for k in range(len(DOMAINS))]
    zero = F.array(*[F.lit(b) for b in model.base])
    scores = F.aggregate(at, zero, lambda acc, i: F.array(*[F.get(acc, F.lit(k)) + F.element_at(columns[k], i) for k in range(len(DOMAINS))]))
    soft = lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s)))
    norm = lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))
    # Binding through one-element arrays computes every step once per row.
    return count, F.transform(F.transform(F.array(scores), soft), norm)[0]


class Step(NamedTuple):
    """Weights of the probabilities that a step takes off, and how far the last move was carried on before it."""

    move: list[float]
    carry: float


def rate_of(p: Column, steps: list[Step], rate: Column | None = None, before: Column | None = None) -> Column:
    """struct(rate, before): a document's rate after the steps and the one before the last, from its probabilities."""
    rate = F.lit(1.0) if rate is None else rate
    before = rate if before is None else before
    start = F.struct(rate.alias("rate"), before.alias("before"))
    if not steps:
        return start
    k = range(len(DOMAINS))
    moves = F.array(*[F.array(*[F.lit(float(x)) for x in (*s.move, s.carry)]) for s in steps])

    def follow(r: Column, g: Column) -> Column:
        point = r["rate"] + g[len(DOMAINS)] * (r["rate"] - r["before"])
        return F.struct(F.greatest(F.lit(0.0), point - sum(p[i] * g[i] for i in k)).alias("rate"), r["rate"].alias("before"))

    return F.aggregate(moves, start, follow)


class Fit(NamedTuple):
    """Steps of the fit, the wanted and the reached tokens of each domain, and how it ended: met, unreachable or unfinished."""

    steps: list[Step]
    wanted: list[float]
    reached: list[float]
    status: str


def fit(rows: DataFrame, targets: dict[str, float] | None = None, most_steps: int = MOST_STEPS) -> Fit:
    """Accelerated projected gradient over rows of (n_tokens, p)."""
    weight = np.array([(targets or TARGETS)[d] for d in DOMAINS])
    k = range(len(DOMAINS))
    cells = [(i, j) for i in k for j in k if i <= j]
    n, p = F.col("n_tokens"), F.col("p")
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0.0)).alias(name)
    one = rows.agg(*[total(n * p[i] * p[j], f"g{i}{j}") for i, j in cells], *[total(n * p[i], f"t{i}") for i in k]).first()
    gram = np.array([[one[f"g{min(i, j)}{max(i, j)}"] for j in k] for i in k])
    now = np.array([one[f"t{i}"] for i in k])
    # A domain without tokens cannot reach any target; its weight goes to the others.
    wanted = np.where(now > 0, weight, 0.0) * now[0] / weight[0] if now[0] > 0 and weight[0] > 0 else now
    scale = np.divide(1.0, np.diag(gram), out=np.zeros(len(now)), where=np.diag(gram) > 0)
    root = np.sqrt(scale)
    length = 1.0 / max(np.linalg.eigvalsh(root[:, None] * gram * root[None, :]).max(), 1e-300)
    size, error = max(now.sum(), 1.0), lambda t: float(((t - wanted) ** 2 * scale).sum())
    steps: list[Step] = []
    held, stored = rows.select(n.alias("n"), p.alias("p"), F.lit(1.0).alias("rate"), F.lit(1.0).alias("before")), 0
    # Tokens reached at the rates and at those before; the point carried on lies on the line through them, as long as it is not cut at 0.
    last, pace, carry = now, 1.0, 0.0
    while True:
        if np.abs(now - wanted).max() <= TOLERANCE * size:
            return Fit(steps, wanted.tolist(), now.tolist(), "met")
        if len(steps) >= most_steps:
            return Fit(steps, wanted.tolist(), now.tolist(), "unfinished")
        ahead = now + carry * (now - last)
        steps.append(Step((length * scale * (ahead - wanted)).tolist(), carry))
        both = held.select("n", "p", rate_of(F.col("p"), steps[stored:], F.col("rate"), F.col("before")).alias("r"))
        move = F.col("r.rate") - F.col("r.before")
        got = both.agg(*[total(F.col("n") * F.col("p")[i] * F.col("r.rate"), f"t{i}") for i in k], total(F.col("n") * move * move, "moved")).first()
        reached = np.array([got[f"t{i}"] for i in k])
        if got.moved <= STILL**2 * size:
            return Fit(steps, wanted.tolist(), reached.tolist(), "met" if np.abs(reached - wanted).max() <= TOLERANCE * size else "unreachable")
        if error(reached) > error(now):
            pace, carry = 1.0, 0.0  # carried too far: start anew from here
        else:
            after = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
            carry, pace = (pace - 1) / after, after
        last, now = now, reached
        if len(steps) - stored == STORE_STEPS:
            held, stored = durable(both.select("n", "p", F.col("r.rate").alias("rate"), F.col("r.before").alias("before"))), len(steps)


def _share(*key: Column | str) -> Column:
    return F.pmod(F.xxhash64(F.lit("mix"), *key), F.lit(1 << 40)) / float(1 << 40)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its tokens, probabilities, rate and number of copies (the rate, its fraction settled by a hash of id and text)."""
    model = train(docs, labels, doc_id, text)
    count, p = membership(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = durable(read(rows).select("doc_id", count.alias("n_tokens"), p.alias("p"), _share("doc_id", "text").alias("at")))
    done = fit(rows, targets)
    out = rows.withColumn("rate", rate_of(F.col("p"), done.steps)["rate"])
    copies = (F.floor("rate") + F.when(F.col("at") < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("long")
    return out.select("doc_id", "n_tokens", *[F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", copies.alias("copies"), F.lit(done.status).alias("fit_status"))


def keep(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` drawn with probability min(1, rate), each once, all columns as they were."""
    model = train(docs, labels, doc_id, text)
    count, p = membership(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    steps = fit(durable(read(rows).select(count.alias("n_tokens"), p.alias("p"))), targets).steps
    whole = F.struct(*[F.col(c) for c in docs.columns])
    drawn = read(docs.select(whole.alias("row"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    # Bound through a one-element array, the probabilities are computed once per row, not once per step.
    rate = F.transform(F.array(p), lambda q: rate_of(q, steps)["rate"])[0]
    return drawn.where(_share("doc_id", "text") < rate).select("row.*")
