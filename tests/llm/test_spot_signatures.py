import hashlib
import re

import xxhash

from tests.conftest import SMALL
from wardflow.llm import queries, spot_signatures as sp


def plain(text, chain=sp.CHAIN):
    """Signature set by a loop over the words."""
    words, marked = [], True
    for piece in re.findall(r"\n|[^\s]+|[ \t\r\f\v]+", "\n" + text.lower()):
        if piece == "\n":
            marked = True
        elif piece.strip() and piece in sp.ANCHORS:
            marked = True
        elif piece.strip():
            words.append((piece, marked))
            marked = False
    signed = lambda s: s - (1 << 64) if s >> 63 else s
    return {signed(xxhash.xxh64(" ".join(w for w, _ in words[i:i + chain]).encode(), seed=42).intdigest()) for i, (_, m) in enumerate(words) if m and i + chain <= len(words)}


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_matches_loops(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id", ascending=False).collect()]
    got = {r.doc_id: r for r in queries.QUERIES["op10_spot_signatures"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    sp.BUCKET_ROWS, kept = 30, sp.BUCKET_ROWS
    try:
        cut = {r.doc_id: r for r in queries.QUERIES["op10_spot_signatures"](spark, SMALL).collect()}
    finally:
        sp.BUCKET_ROWS = kept
    assert cut == got
    for k, (i, text) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        r, own = got[i], plain(text)
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r.near_edited - like(own, plain(edited))) < 1e-9 and abs(r.near_next - like(own, plain(other))) < 1e-9
        assert int(r.fingerprint.split(":")[0]) == len(own)


def test_edge_rows(spark):
    rows = [(5, None, "x"), (4, "", "x"), (3, "the", "x"), (2, "the cat of sat", "x"), (2, "the cat of sat", "x"), (None, "a b c d", "x"), (1, "w " * 60000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sigs string")
    got = sp.compare(df).collect()
    assert len(got) == len(rows)
    assert sp.compare(df.limit(0)).count() == 0
    assert [r.near_next for r in got if r.doc_id == 5] == [1.0]
