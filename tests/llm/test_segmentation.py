import math
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tests.conftest import SMALL
from wardflow.llm import queries, segmentation as sg

SP = sentencepiece.SentencePieceProcessor(model_file=sg.MODEL)


@pytest.fixture(scope="module")
def model():
    return sg.load()


def paths(text, model):
    """All segmentations of a text with their probabilities, by plain recursion over the model's pieces."""
    weight = {SP.id_to_piece(i): w for i, w in enumerate(model.weight) if not (SP.is_byte(i) or SP.is_control(i) or SP.is_unknown(i))}
    ids = {p: SP.piece_to_id(p) for p in weight}
    text = "▁" + text.replace("▁", "\0").replace(" ", "▁") if text else ""
    out = []

    def go(at, done, total):
        if at == len(text):
            out.append((tuple(done), total))
        for n in range(1, min(16, len(text) - at) + 1):
            p = text[at:at + n]
            if p in weight:
                go(at + n, [*done, ids[p]], total + weight[p])
            elif n == 1:
                raw = p.replace("\0", "▁").encode()
                go(at + 1, [*done, *[int(model.byte_id[b]) for b in raw]], total + model.back * len(raw))

    go(0, [], 0.0)
    norm = math.log(sum(math.exp(t) for _, t in out))
    return {p: t - norm for p, t in out}


@pytest.mark.parametrize("text", ["", "a", "the", "in it", "a▁b", "né\n😀", "  ab", "ab "])
def test_samples_are_distinct_segmentations_with_their_probability(model, text):
    want = paths(text, model)
    got = sg.sample([text] * 50, np.arange(50), model, 6)
    for samples in got:
        assert len(samples) == min(6, len(want)) == len({tuple(x[0].tolist()) for x in samples})
        keys = [x[2] for x in samples]
        assert keys == sorted(keys, reverse=True)
        for ids, logp, _, _ in samples:
            assert abs(want[tuple(ids.tolist())] - logp) < 1e-6
            assert sg.decoded(ids, np.array([0, len(ids)]), model).row(0).decode() == text


def test_order_and_inclusion_follow_sampling_without_replacement(model):
    text, n, k = "onin a", 6000, 3
    want = {p: math.exp(t) for p, t in paths(text, model).items()}
    got = sg.sample([text] * n, np.arange(n) * 7919, model, k)
    first, pairs, weight = Counter(), Counter(), Counter()
    for samples in got:
        ids = [tuple(x[0].tolist()) for x in samples]
        first[ids[0]] += 1
        pairs[ids[0], ids[1]] += 1
        for p, x in zip(ids, samples):
            weight[p] += math.exp(x[1] - x[3])
    likely = sorted(want, key=want.get)[-4:]
    for p in likely:
        assert abs(first[p] / n - want[p]) < 5 * math.sqrt(want[p] * (1 - want[p]) / n)
        # Probability over inclusion score is an unbiased estimate of the probability.
        assert abs(weight[p] / n - want[p]) < 0.05 * max(want[p], 0.1)
        for q in likely:
            if p != q:
                both = want[p] * want[q] / (1 - want[p])
                assert abs(pairs[p, q] / n - both) < 5 * math.sqrt(both / n) + 1e-3


def test_query_is_lossless_and_repeatable(spark):
    got = queries.QUERIES["op1_sampled_segmentations"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.lossless for r in got) and Counter(r.sample for r in got) == {i: docs for i in range(1, sg.SAMPLES + 1)}
    again = queries.QUERIES["op1_sampled_segmentations"](spark, SMALL).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_edge_rows(spark):
    texts = [None, "", " ", "a", "x" * 30000, "word " * 20000, "▁▁ ▁", "\t\n\r", "é漢😀" * 300, " " * 5000]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "null id", "s")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sg.decode(sg.encode(df, 3)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
        if r.doc_id is not None:
            assert r.text == (texts[r.doc_id] or "")
    assert len(by[0]) == len(by[1]) == 1 and by[0][0].ids == [] and by[0][0].log_inclusion == 0
    assert len(by[4]) == len(by[5]) == len(by[9]) == 3 and len(by[None]) == 6
    assert sg.encode(df.limit(0)).count() == 0
