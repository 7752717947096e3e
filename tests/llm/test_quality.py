import re
from collections import Counter

from wardflow.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """Measurements by plain loops."""
    text = text or ""
    w = WORD.findall(text)
    seen, dup, used = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            used += 1
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(w[j:j + 8]) for j in range(len(w) - 7))
    cover = set()
    for j in range(len(w) - 7):
        if runs[tuple(w[j:j + 8])] > 1:
            cover.update(range(j, j + 8))
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": len(cover), "n_lines": used, "n_letters": len(re.findall("[A-Za-zÀ-\U0010ffff]", text)),
        "n_shouted": sum(len(re.findall("[A-Z]", x)) > 1 and not re.search("[a-z]", x) for x in w),
        "n_stutters": sum(a == b for a, b in zip(w, w[1:])),
    }


HARD = [
    None, "", " \n\t\n ", "one", "a\n\na\na \n", "x\n" * 9, "a b c d e f g h " * 3, "A B c. ÉÉ É É 漢字 😀", "é" * 70000, ("word " * 40 + "\n") * 50,
    "a b c d e f g h", "b\nb", "\n", "SHOUT LOUD " * 15, "p | q | " * 20, "\r\na\r\na\r\n", "end\n",
]


def test_measures_match_loops(spark):
    rows = [(i, x, "extra", 7) for i, x in enumerate(HARD)] + [(2, "twice", "e", 1), (2, "twice", "e", 1), (None, "no id", None, None)]
    got = quality.ledger(spark.createDataFrame(rows, "doc_id long, text string, failed string, n_words int")).collect()
    assert len(got) == len(rows)
    want = Counter((i, *plain(x).values()) for i, x, *_ in rows)
    assert Counter((r.doc_id, *[r[m] for m in quality.MEASURES]) for r in got) == want


def test_query_matches_sql(same_as_sql):
    same_as_sql("op5_quality_ledger")


def test_policies_and_ablations(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(HARD)], "doc_id long, text string")
    led = quality.ledger(df)
    bits = [r.failed for r in led.collect()]
    for policy in quality.POLICIES:
        m = quality.mask(policy)
        kept = sum(not b & m for b in bits)
        assert led.where(quality.passes(policy)).count() == kept
        got = {r.rule: r for r in quality.ablations(led, policy).collect()}
        for name, r in got.items():
            bit = 1 << quality.BITS[name]
            assert (r.n_rows, r.kept) == (len(bits), kept)
            assert r.n_failed == sum(bool(b & bit) for b in bits)
            assert r.kept_without == sum(not b & m & ~bit for b in bits)


def test_keep_agrees_with_ledger_and_keeps_columns(spark):
    df = spark.createDataFrame([(i, x, "s") for i, x in enumerate(HARD)], "doc_id long, text string, n_words string")
    kept = {r.doc_id for r in quality.ledger(df).where(quality.passes()).collect()}
    out = quality.keep(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == kept
    assert quality.keep(df.limit(0)).count() == 0 and quality.ledger(df.limit(0)).count() == 0
