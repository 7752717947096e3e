import gzip
import hashlib
import zlib

import pytest

from wardflow.llm import urlfilter, warc


@pytest.mark.parametrize("name", ["op2_warc_round_trip", "op4_url_filter"])
def test_query_matches_sql(same_as_sql, name):
    same_as_sql(name)


PAGES = [
    (1, "http://a/x", "p" * 2000), (2, "http://a/y", "p" * 2000), (3, None, "p" * 2000), (4, "u\r\nX: 1", "é" * 499), (5, "u", "é" * 499), (6, "u", None), (7, "u", ""),
    (8, "u", "é" * 500), (9, "u", "é" * 500), (9, "u", "é" * 500), (None, "u", "p" * 2000), (10, "u", "\r\n\r\n" * 400), (11, "u", "x" * 3_000_000),
]


def test_archives_round_trip(spark):
    df = spark.createDataFrame([(*p, "e") for p in PAGES], "page_id long, url string, html string, refers_to string")
    files = warc.write(df)
    got = warc.read(files, payloads=True).collect()
    assert len(got) == len(PAGES) == files.groupBy().sum("n_records").first()[0]
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r)
    for i, _, html in PAGES:
        data = (html or "").encode()
        for r in by[i]:
            assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
            assert r.payload == (data if r.record_type == "response" else None) and r.digest_ok in (True, None)
    assert {i: (by[i][0].record_type, by[i][0].refers_to) for i in (1, 2, 3, 4, 5, 8)} == {
        1: ("revisit", 3), 2: ("revisit", 3), 3: ("response", None), 4: ("response", None), 5: ("response", None), 8: ("revisit", 9)}
    assert [r.record_type for r in by[9]] == ["response"] * 2 and by[None][0].record_type == "response"
    assert warc.round_trip(df.limit(0)).count() == 0


def test_reader_works_at_any_chunk_size_and_refuses_broken_archives():
    whole = b"".join(warc.member(warc.record(i, "u", b"x" * i * 50, None)) for i in range(5))
    assert gzip.decompress(whole).count(b"WARC/1.1") == 5
    for size in (1, 7, 1000, len(whole)):
        got = list(warc.records(iter([whole[i:i + size] for i in range(0, len(whole), size)])))
        assert [(r[0], r[4], r[6]) for r in got] == [(i, i * 50, True) for i in range(5)]
    with pytest.raises(warc.BadArchive):
        list(warc.records(iter([whole[:-9]])))
    rec = warc.record(1, "u", b"abc", None)
    with pytest.raises(warc.BadArchive):
        list(warc.records(iter([warc.member(rec + rec)])))
    assert list(warc.records(iter([warc.member(rec.replace(b"abc", b"abd"))])))[0][6] is False
    with pytest.raises(zlib.error):
        list(warc.records(iter([b"plain text"])))


URLS = [
    (0, "HTTP://WWW.Example.ORG/es/1?b=2&a=1&utm_source=x#top"), (1, "http://sub.example.org/en/12"), (2, "https://example.org"), (3, "http://notexample.org/es/"), (4, "x.com/fr/"),
    (5, None), (6, ""), (7, "http://com/fr/"), (8, "http://a.b.com/de/q?x"), (9, "http://list.net/a/"), (10, "https://www.list.net:443/a/index.html?ref=1"), (10, "https://www.list.net:443/a/index.html?ref=1"),
    (11, "a://b://c/d"), (12, "http://x.net/" + "y" * 40000), (None, "http://list.net/a"),
]


def test_rules_and_list(spark):
    df = spark.createDataFrame([(i, u, "e") for i, u in URLS], "page_id long, url string, host string")
    listed = spark.createDataFrame([("list.net/a",), ("list.net/a",), (None,), ("example.org",)], "url string")
    got = urlfilter.judge(df, listed).collect()
    assert len(got) == len(URLS)
    by = {r.page_id: (r.host, r.rule, r.verdict, r.listed) for r in got}
    assert by[0] == ("www.example.org", "example.org/es/", "block", False)
    assert by[1] == ("sub.example.org", "example.org/en/1", "block", False)
    assert by[2] == ("example.org", None, "block", True) and by[3] == ("notexample.org", "org/", "allow", False)
    assert by[4] == by[5] == by[6] == ("", None, "allow", False)
    assert by[7] == ("com", "com/fr/", "allow", False) and by[8][1:3] == ("com/de/", "block")
    assert by[9][2:] == by[10][2:] == by[None][2:] == ("block", True)
    assert by[11][0] == "b:" and by[12][2:] == ("allow", False)
    assert not any(r.listed for r in urlfilter.judge(df, listed.limit(0)).collect())


def test_filter_has_no_false_negative_and_few_false_positives(spark):
    n = 4000
    listed = spark.range(n).selectExpr("concat('site/', id) as url")
    bits = urlfilter.build(listed, urlfilter.blocks_for(n))
    every = spark.range(3 * n).selectExpr("concat('site/', id) as key", "id")
    held = every.withColumn("block", urlfilter._block(every.key, urlfilter.blocks_for(n))).join(bits, "block")
    for i, m in enumerate(urlfilter._masks(every.key)):
        held = held.where(bits[f"w{i}"].bitwiseAND(m) == m)
    passed = {r.id for r in held.select("id").collect()}
    assert set(range(n)) <= passed and len(passed) - n < 0.01 * 2 * n
    assert {r.id for r in urlfilter.is_listed(every, listed).where("listed").collect()} == set(range(n))


def test_rows_that_share_an_id_keep_their_payloads(spark):
    a, b = "A" * 1200, "B" * 1200
    pages = spark.createDataFrame([(5, "u", a), (5, "u", b), (9, "u", a), (8, "u", b)], "page_id long, url string, html string")
    got = warc.round_trip(pages).collect()
    digest = {hashlib.sha1(x.encode()).hexdigest(): x[0] for x in (a, b)}
    assert sorted((r.page_id, digest[r.payload_digest], r.record_type, r.refers_to) for r in got) == [
        (5, "A", "revisit", 9), (5, "B", "revisit", 8), (8, "B", "response", None), (9, "A", "response", None)]
    assert urlfilter.judge(pages.limit(0), pages.select("url")).count() == 0


def test_query_finds_other_spellings_of_listed_addresses(spark, tmp_path):
    from wardflow.llm import queries

    raw = [f"http://www.site.net/{i}" for i in range(400)]
    pages = [(i, u) for i, u in enumerate(raw)] + [(1000 + i, f"HTTPS://site.net:443/{i}/index.html?utm_source=x#t") for i in range(400)]
    spark.createDataFrame(pages, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r.listed for r in queries.QUERIES["op4_url_filter"](spark, str(tmp_path)).collect()}
    wanted = {u for _, u in pages if hashlib.md5(u.encode()).hexdigest()[0] in queries.LISTED_DIGITS}
    both = [u in wanted or v in wanted for (_, u), (_, v) in zip(pages[:400], pages[400:])]
    assert [got[i] for i in range(400)] == both == [got[1000 + i] for i in range(400)]
    assert 0 < len(wanted) < sum(got.values())
