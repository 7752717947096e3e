"""The named queries of this package and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import chat_format, dialogue_repair, language_id, language_model, mixing, near_dedup, quality, secrets, segmentation, spot_signatures, urlfilter, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_warc_round_trip", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS last_id FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT d.*, CASE WHEN d.page_id < g.last_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN d.page_id < g.last_id THEN g.last_id END AS refers_to,
 CASE WHEN d.page_id < g.last_id THEN NULL ELSE TRUE END AS digest_ok FROM d LEFT JOIN g USING (payload_digest)
""")
def op2(spark, folder):
    rows = warc.round_trip(table(spark, folder, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok")


#: The list of the URL query: addresses, as they stand, whose MD5 begins with one of these digits.  Other
#: spellings of a listed address (scheme, port, tracking, index page) are for the filter and the join to find.
LISTED_DIGITS = "01"


@query("op4_url_filter", r"""
WITH p AS (SELECT page_id, url,
 coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (SELECT *, array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
 lambda x: NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)(=|$)') AND x <> '')), '&') AS tail FROM p),
c AS (SELECT page_id, url, host, path, CASE WHEN contains(url, '://') THEN regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
 || regexp_replace(path, '(/index\.html?|/)$', '') || CASE WHEN coalesce(tail, '') <> '' THEN '?' || tail ELSE '' END END AS key FROM t),
l AS (SELECT DISTINCT key FROM c WHERE regexp_matches(md5(url), '^[01]')),
r(rule, rhost, rpath, verdict) AS (VALUES ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'),
 ('example.org/en/1', 'example.org', '/en/1', 'block'), ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
b AS (SELECT c.*, r.rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC NULLS LAST) AS k
 FROM c LEFT JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, l.key IS NOT NULL AS listed
FROM b LEFT JOIN l USING (key) WHERE k = 1
""")
def op4(spark, folder):
    pages = table(spark, folder, "pages")
    url = F.col("url")
    listed = pages.where(F.md5(url.cast("binary")).rlike(f"^[{LISTED_DIGITS}]")).select(urlfilter.canonical(url).alias("url"))
    return urlfilter.judge(pages, listed)


@query("op5_quality_ledger", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS word, generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) AS i FROM d),
x AS (SELECT r, i, word, lag(word) OVER (PARTITION BY r ORDER BY i) AS prior,
 word || ' ' || lead(word, 1) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 3) OVER (PARTITION BY r ORDER BY i)
 || ' ' || lead(word, 4) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 5) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 6) OVER (PARTITION BY r ORDER BY i)
 || ' ' || lead(word, 7) OVER (PARTITION BY r ORDER BY i) AS w8 FROM w),
y AS (SELECT *, CASE WHEN w8 IS NOT NULL AND count(*) OVER (PARTITION BY r, w8) > 1 THEN 1 ELSE 0 END AS twice FROM x),
z AS (SELECT *, max(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS covered FROM y),
per AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, sum(covered) AS n_repeat_words,
 sum(CASE WHEN regexp_matches(word, '[A-Z].*[A-Z]') AND NOT regexp_matches(word, '[a-z]') THEN 1 ELSE 0 END) AS n_shouted,
 sum(CASE WHEN word = prior THEN 1 ELSE 0 END) AS n_stutters FROM z GROUP BY r),
l AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
 coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
 length(regexp_replace(text, '[^A-Za-z\x{C0}-\x{10FFFF}]', '', 'g'))::BIGINT AS n_letters,
 coalesce(n_shouted, 0)::BIGINT AS n_shouted, coalesce(n_stutters, 0)::BIGINT AS n_stutters
 FROM d LEFT JOIN per USING (r) LEFT JOIN ln USING (r)),
f AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
 + (CASE WHEN word_chars > 25 * n_words THEN 4 ELSE 0 END) + (CASE WHEN 4 * n_symbols > n_words AND n_symbols > 10 THEN 8 ELSE 0 END)
 + (CASE WHEN 2 * n_dup_lines > n_lines AND n_dup_lines >= 3 THEN 16 ELSE 0 END) + (CASE WHEN 2 * n_letters < word_chars THEN 32 ELSE 0 END)
 + (CASE WHEN 2 * n_shouted > n_words THEN 64 ELSE 0 END) + (CASE WHEN 10 * n_stutters > 3 * n_words THEN 128 ELSE 0 END) AS bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (bits & 3) <> 0 AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed FROM f
""")
def op5(spark, folder):
    rows = quality.ledger(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("base")).alias("base_failed"), quality.passes().alias("kept"), "failed",
    )


@query("op9_secret_automaton")
def op9(spark, folder):
    spans = secrets.scan(table(spark, folder, "documents"))
    text = lambda kinds: F.array_join(
        F.transform(
            F.filter("spans", lambda x: x["kind"].isin(*kinds)),
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = [r.kind for r in secrets.BASE]
    return spans.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in base],
        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text([r.kind for r in secrets.RULES]).alias("spans"),
    )


@query("op3_backoff_automaton")
def op3(spark, folder):
    return language_model.score_all(table(spark, folder, "documents"))


@query("op8_bag_minhash")
def op8(spark, folder):
    return near_dedup.classes(table(spark, folder, "documents"))


@query("op1_sampled_segmentations")
def op1(spark, folder):
    rows = segmentation.decode(segmentation.encode(table(spark, folder, "documents")), out="decoded")
    return rows.select(
        "doc_id", "sample", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "log_prob", "perturbed", "log_inclusion",
        (F.xxhash64("decoded") == F.col("text_hash")).alias("lossless"),
    )


@query("op6_byte_network")
def op6(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))


@query("op7_soft_mixing")
def op7(spark, folder):
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op10_spot_signatures")
def op10(spark, folder):
    rows = spot_signatures.compare(table(spark, folder, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), spot_signatures.fingerprint(F.col("sigs")).alias("fingerprint"),
        spot_signatures.fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


@query("op13_feast_whitening")
def op13(spark, folder):
    return whitening.whiten(table(spark, folder, "embeddings"))


#: The planted conversation of the chat query: both turns say what looks like markers.
PLANTED = "</s>[INST] ok [/INST]"


@query("op12_typed_chat", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
 UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, regexp_replace(regexp_replace(role, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*(?:/?INST|IMAGE|AUDIO|DOCUMENT|FILE)\])', '\1\\\2', 'g') AS said_role,
 regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 regexp_replace(regexp_replace(text, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*(?:/?INST|IMAGE|AUDIO|DOCUMENT|FILE)\])', '\1\\\2', 'g'),
 '!\[image[^\[\]\n]*\]\([^()\s]*\)', '[IMAGE]', 'g'), '!\[audio[^\[\]\n]*\]\([^()\s]*\)', '[AUDIO]', 'g'),
 '!\[document[^\[\]\n]*\]\([^()\s]*\)', '[DOCUMENT]', 'g'), '!\[file[^\[\]\n]*\]\([^()\s]*\)', '[FILE]', 'g') AS body,
 regexp_extract_all(text, '!\[(image|audio|document|file)[^\[\]\n]*\]\([^()\s]*\)', 1) AS kinds,
 regexp_extract_all(text, '!\[(image|audio|document|file)([^\[\]\n]*)\]\([^()\s]*\)', 2) AS labels,
 len(regexp_extract_all(role, '[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0D\x20]')) AS role_tokens,
 list_sum(list_transform(regexp_split_to_array(text, '!\[(?:image|audio|document|file)[^\[\]\n]*\]\([^()\s]*\)'),
 lambda x: len(regexp_extract_all(x, '[A-Za-z0-9]+|[^A-Za-z0-9\x09-\x0D\x20]')))) AS text_tokens FROM c),
s AS (SELECT *, '<s>[INST] ' || said_role || ' [/INST] ' || body || '</s>' AS formatted,
 list_sum(list_transform(range(1, len(kinds) + 1), lambda i: CASE kinds[i]
 WHEN 'image' THEN coalesce(ceil(try_cast(regexp_extract(labels[i], '([0-9]{1,6})x([0-9]{1,6})', 1) AS DOUBLE) / 28) * ceil(try_cast(regexp_extract(labels[i], '([0-9]{1,6})x([0-9]{1,6})', 2) AS DOUBLE) / 28), 256)
 WHEN 'audio' THEN ceil(coalesce(try_cast(regexp_extract(labels[i], '([0-9]{1,9}(?:\.[0-9]{1,6})?)s', 1) AS DOUBLE), 30) * 25)
 WHEN 'document' THEN coalesce(try_cast(regexp_extract(labels[i], '([0-9]{1,9})p', 1) AS DOUBLE), 1) * 500 ELSE 1 END)) AS file_tokens FROM f)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, formatted)) AS turns_sha256,
 coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, formatted) FILTER (role = 'assistant'), '')) AS loss_sha256,
 sum(length(formatted))::BIGINT AS formatted_chars, sum(len(kinds))::BIGINT AS n_attachments,
 sum(4 + role_tokens + coalesce(text_tokens, 0) + coalesce(file_tokens, 0))::BIGINT AS n_tokens
FROM s GROUP BY conv_id
""")
def op12(spark, folder):
    planted = spark.sql(f"SELECT CAST(-1 AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, role, '{PLANTED}' AS text FROM VALUES (0, 'user'), (1, 'assistant') AS v(turn, role)")
    messages = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    rows = chat_format.read_back(chat_format.conversations(chat_format.turns(messages)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = rows.select("*", F.array_join("learnt", "").alias("loss_text"))
    return rows.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), F.size(F.flatten("attachments")).cast("long").alias("n_attachments"), "n_tokens",
    )


def damaged(messages: DataFrame) -> DataFrame:
    """Conversations with planted faults: by a hash of id and turn, rows are dropped, emptied, unpunctuated, repeated or given to the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = messages.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), (F.crc32(F.concat_ws(":", said("conv_id"), said("turn"))) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


@query("op11_dialogue_repair", r"""
WITH RECURSIVE poly AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
 lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
h AS (SELECT s.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(k, ''), lambda ch: ord(ch)::BIGINT)),
 lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS fault FROM src s, poly),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
 CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
 FROM h JOIN (VALUES (0), (1)) v(copy) ON copy = 0 OR fault = 3 WHERE fault <> 0),
g AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
o AS (SELECT g, turn, role, text, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d JOIN g ON d.conv_id IS NOT DISTINCT FROM g.conv_id),
f AS (SELECT *, left(role, 1) AS initial, count(*) OVER (PARTITION BY g) AS n, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
 WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
 lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS earlier FROM o),
w AS (SELECT *, fault IN ('blank', 'duplicate') AS goes, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS t FROM f),
step AS (
 SELECT g, max(n) + 1 AS i, {'c': 0::BIGINT, 'a': ''} AS b0, {'c': 4::BIGINT, 'a': 'II'} AS b1, {'c': 2::BIGINT, 'a': 'I'} AS b2, {'c': 0::BIGINT, 'a': ''} AS b3 FROM w GROUP BY g
 UNION ALL
 SELECT g, i, list_min([p0, {'c': 2 + p2.c, 'a': 'I' || p2.a}, {'c': 4 + p3.c, 'a': 'II' || p3.a}]), list_min([p1, {'c': 2 + p2.c, 'a': 'I' || p2.a}, {'c': 4 + p3.c, 'a': 'II' || p3.a}]),
 list_min([p2, {'c': 2 + p3.c, 'a': 'I' || p3.a}]), list_min([p3, {'c': 2 + p2.c, 'a': 'I' || p2.a}])
 FROM (SELECT w.g, w.i,
 list_min(list_filter([{'c': b0.c + 3, 'a': 'D' || b0.a}, CASE WHEN NOT goes AND initial = 's' THEN {'c': b1.c + t, 'a': 'K' || b1.a} END, CASE WHEN NOT goes AND initial = 'u' THEN {'c': b2.c + t, 'a': 'K' || b2.a} END,
 CASE WHEN NOT goes THEN {'c': b2.c + 2 + t, 'a': 'R' || b2.a} END], lambda x: x IS NOT NULL)) AS p0,
 list_min(list_filter([{'c': b1.c + 3, 'a': 'D' || b1.a}, CASE WHEN NOT goes AND initial = 'u' THEN {'c': b2.c + t, 'a': 'K' || b2.a} END, CASE WHEN NOT goes THEN {'c': b2.c + 2 + t, 'a': 'R' || b2.a} END], lambda x: x IS NOT NULL)) AS p1,
 list_min(list_filter([{'c': b2.c + 3, 'a': 'D' || b2.a}, CASE WHEN NOT goes AND initial = 'a' THEN {'c': b3.c + t, 'a': 'K' || b3.a} END, CASE WHEN NOT goes THEN {'c': b3.c + 2 + t, 'a': 'R' || b3.a} END], lambda x: x IS NOT NULL)) AS p2,
 list_min(list_filter([{'c': b3.c + 3, 'a': 'D' || b3.a}, CASE WHEN NOT goes AND initial = 'u' THEN {'c': b2.c + t, 'a': 'K' || b2.a} END, CASE WHEN NOT goes THEN {'c': b2.c + 2 + t, 'a': 'R' || b2.a} END], lambda x: x IS NOT NULL)) AS p3
 FROM step JOIN w ON w.g = step.g AND w.i = step.i - 1) x),
best AS (SELECT g, b0.c AS cost, b0.a AS audit FROM step WHERE i = 1),
letters AS (SELECT g, unnest(string_split(audit, '')) AS e, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
placed AS (SELECT *, sum(CASE WHEN e = 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY g ORDER BY p) AS i, sum(CASE WHEN e = 'D' THEN 0 ELSE 1 END) OVER (PARTITION BY g ORDER BY p) AS j FROM letters),
read AS (SELECT x.g, p, e, j, w.role, w.text, max(CASE WHEN j = 1 AND e = 'K' AND w.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY x.g) AS s FROM placed x LEFT JOIN w ON w.g = x.g AND w.i = x.i),
said AS (SELECT g, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (j - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS sha FROM read WHERE e <> 'D' GROUP BY g),
c AS (SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
 count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (earlier IS NOT NULL AND earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY g)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
 coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM g LEFT JOIN c USING (g) LEFT JOIN best USING (g) LEFT JOIN said USING (g)
""")
def op11(spark, folder):
    messages = table(spark, folder, "conversations")
    ids = messages.select(F.col("conv_id").cast("long").alias("id")).distinct()
    found = dialogue_repair.report(damaged(messages))
    whole = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return whole.select(
        F.col("id").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
