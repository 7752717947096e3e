import zlib
from collections import Counter

import numpy as np

from tests.conftest import SMALL
from wardflow.llm import language_id as li, queries, textscan as ts


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = queries.QUERIES["op6_byte_network"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.93 * len(held)


def test_tables_match_plain_convolution():
    rng = np.random.default_rng(0)
    net = li.fit(rng.integers(97, 123, (40, li.LENGTH)).astype(np.uint8), rng.integers(0, 3, 40), ("a", "b", "c"), epochs=1)
    data = rng.integers(0, 256, (5, li.LENGTH)).astype(np.uint8)
    pooled = []
    for w, f in zip(li.WIDTHS, net.filters):
        z = np.array([[[sum(f[j][x[t + j]][k] for j in range(w)) for k in range(li.FILTERS)] for t in range(li.LENGTH - w + 1)] for x in data])
        pooled.append(np.maximum(z.max(axis=1), 0))
    want = li._softmax(np.concatenate(pooled, axis=1) @ net.out + net.bias)
    assert np.allclose(li.Applied(net).probabilities(data), want, atol=1e-4)


def test_windows_cover_whole_texts():
    rows = [b"", b"a" * 128, b"B" * 129, "é".encode() * 500]
    t = ts.Texts(np.frombuffer(b"".join(rows), np.uint8), np.cumsum([0] + [len(x) for x in rows]))
    data, row = li.windows(t)
    assert Counter(row.tolist()) == {1: 1, 2: 2, 3: 8}
    for i, x in enumerate(rows):
        assert data[row == i].tobytes().rstrip(b" ") == x.lower()


def test_edge_rows(spark):
    a, b = "the cat and the dog went out ", "der hund und die katze sind weg "
    rows = [(i, (a if i % 2 else b) * 5, "en" if i % 2 else "de") for i in range(60)]
    odd = [(100, None, "en"), (101, "", None), (102, "123 !!", "en"), (103, "漢字", None), (104, "😀€", None), (105, a * 4000, None), (None, a, None), (None, a, None), (1, rows[1][1], "en")]
    df = spark.createDataFrame([(*r, 9.0) for r in rows + odd], "doc_id long, text string, lang string, score double")
    got = li.identify(df).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == ("en" if i % 2 else "de") for i in range(60))
    assert [by[i].lang_pred for i in (100, 101, 102, 104)] == ["und"] * 4 and by[100].score == 0
    assert by[103].lang_pred in ("en", "de") and by[105].lang_pred == "en" and by[None].lang_pred == "en"
    assert li.identify(df.limit(0)).count() == 0
    nothing = li.identify(spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)


def test_scores_do_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    score = lambda rows: {r.doc_id: (r.lang_pred, r.score) for r in li.identify(rows).collect()}
    assert score(docs) == score(docs.orderBy("text").repartition(7))
