import corpus_pipeline as cp
from tests.conftest import SMALL
from tests.llm.test_near_dedup import plain_classes
from tests.llm.test_secrets import plain as plain_secrets
from wardflow.llm import quality
from wardflow.llm.segmentation import decode


def test_stages_against_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    seen = []
    for name, stage in cp.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen.append(docs)
    rules, near, masked, mixed, encoded = seen
    assert all(x.columns == columns for x in seen[:-1])
    text = lambda x: {r.doc_id: r.text for r in x.collect()}
    start = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert set(text(rules)) == {r.doc_id for r in quality.ledger(start).where(quality.passes()).collect()}
    assert set(text(near)) == set(plain_classes(list(text(rules).items())).values())
    before, after = text(near), text(masked)
    assert set(before) == set(after)
    for i, t in before.items():
        assert (after[i] == t) == (not plain_secrets(t)) or "<" in after[i]
        assert not plain_secrets(after[i])
    kept = text(mixed)
    assert all(after[i] == t for i, t in kept.items())
    clean = [i for i in after if i in labels and labels[i].quality == 1 and not labels[i].toxic]
    assert sum(i in kept for i in clean) >= 0.95 * len(clean)
    back = decode(encoded).collect()
    assert {r.doc_id for r in back} == set(kept) and all(r.text == kept[r.doc_id] for r in back)


def folder_of(spark, path, docs, labels):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _name int, row int, bands int"
    spark.createDataFrame(docs, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_run_over_nulls_ties_and_clashing_names(spark, tmp_path):
    said = lambda k: " ".join(f"word{(i * 7 + k) % 113} and{i % 17} more{i * k % 29}" for i in range(40)) + "."
    letters = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    long = " ".join(f"long{letters(i)} tail{letters(i * 3)}" for i in range(60_000))
    rows = [(1, said(1)), (2, said(1)), (3, said(2)), (None, said(3)), (None, None), (4, None), (5, ""), (6, "   "), (7, said(4)), (7, said(4)), (8, long)]
    path = folder_of(spark, tmp_path / "some", [(i, x, "en", "s", 1, 1, 2, 3) for i, x in rows], [])
    got = decode(cp.run(spark, path)).collect()
    texts = dict(rows)
    assert {r.doc_id for r in got} == {None, 1, 3, 7, 8}  # null, empty and short texts go by the rules, 2 by its copy
    assert all(r.text == texts[r.doc_id] for r in got if r.doc_id is not None)


def test_run_over_empty_tables(spark, tmp_path):
    out = cp.run(spark, folder_of(spark, tmp_path / "none", [], []))
    assert out.count() == 0 and "ids" in out.columns
