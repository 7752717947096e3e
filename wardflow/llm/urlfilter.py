"""URL filters: a blocked Bloom filter in front of an exact hash join.

Listed URLs are made canonical and folded into blocks of 256 bits, one row per
block, by ``bit_or``.  Pages meet only the block of their own canonical URL;
what it passes goes on to an equi-join with the list, which removes the false
positives.  Pages the filter rejects never reach that join.  Domain rules over
(host, path) come first; the longest fitting rule decides.

All steps are SQL expressions.  The block table is broadcast only if the counted
size of the list keeps it under ``BROADCAST_BYTES``; beyond that it is joined by
block number.

Cases: a null URL or one without ``://`` has empty host and path, fits no rule and
is not listed; repeated rows stay repeated; null and repeated list entries are
harmless; an empty list passes nothing; extra columns of the list are not read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_URL = 16
BLOCK_BITS = 256
PROBES = 8
BLOCK_ROW_BYTES = 48
BROADCAST_BYTES = 16 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that do not change the page.
TRACKING = r"(utm_[a-z]+|ref|fbclid|gclid)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The domain rules.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` or default port, path without a last slash or index page, query without tracking, no scheme or fragment.

    Null if the URL is null or has no ``://``.
    """
    site = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    place = F.regexp_replace(path(url), r"(/index\.html?|/)$", "")
    asked = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(asked, "&"), lambda p: ~p.rlike(f"^{TRACKING}(=|$)") & (p != ""))
    tail = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(site, place, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit("")))
    return F.when(url.contains("://"), whole)


def fitting_rule(site: Column, place: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((site == rule.host) | site.endswith("." + rule.host)) & place.startswith(rule.path)
        text, verdict = F.when(fits, F.lit(rule.text)).otherwise(text), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _masks(url: Column) -> list[Column]:
    """Four words of 64 bits with the probe bits of one URL."""
    h = F.xxhash64(F.lit("bits"), url)
    words = [F.lit(0).cast("long")] * 4
    for j in range(PROBES):
        place = F.shiftrightunsigned(h, 8 * j).bitwiseAND(F.lit(BLOCK_BITS - 1))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
        words = [w.bitwiseOR(F.when(F.shiftright(place, 6) == i, bit).otherwise(F.lit(0).cast("long"))) for i, w in enumerate(words)]
    return words


def _block(url: Column, blocks: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("block"), url), 8).bitwiseAND(F.lit(blocks - 1)).cast("int")


def blocks_for(n: int) -> int:
    """Power of two of blocks that gives each of ``n`` URLs its bits."""
    need = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    return 1 << (need - 1).bit_length()


def build(listed: DataFrame, blocks: int, url: str = "url") -> DataFrame:
    """Filter blocks of canonical URLs: (block, w0, w1, w2, w3), blocks without a URL left out."""
    u = F.col(url)
    words = _masks(u)
    return (
        listed.where(u.isNotNull())
        .select(_block(u, blocks).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(words)])
        .groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])
    )


def is_listed(pages: DataFrame, listed: DataFrame, key: str = "key", url: str = "url") -> DataFrame:
    """``pages`` with a boolean ``listed``; ``key`` and ``url`` hold canonical URLs."""
    wanted = listed.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    blocks = blocks_for(wanted.count())
    bits = build(wanted, blocks, "_url").select(F.col("block").alias("_block"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(4)])
    if blocks * BLOCK_ROW_BYTES <= BROADCAST_BYTES:
        bits = F.broadcast(bits)
    held = [F.col(f"_w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))]
    # A null key gets no block; a block of its own per row keeps such rows from meeting in one task.
    spread = F.when(F.col(key).isNull(), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20)).cast("int")).otherwise(_block(F.col(key), blocks))
    probed = pages.withColumn("_block", spread).join(bits, "_block", "left")
    passed = F.coalesce(F.col(key).isNotNull() & held[0] & held[1] & held[2] & held[3], F.lit(False))
    probed = probed.withColumn("_passed", passed).drop("_block", *[f"_w{i}" for i in range(4)])
    out = probed.where(~F.col("_passed")).withColumn("listed", F.lit(False))
    hits = probed.where("_passed").join(wanted.hint("shuffle_hash"), F.col(key) == F.col("_url"), "left")
    return out.unionByName(hits.withColumn("listed", F.col("_url").isNotNull()).drop("_url")).drop("_passed")


def judge(pages: DataFrame, listed: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rule and verdict of every page; without a rule, listed pages are blocked and the others allowed."""
    u = F.col("_u")
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("_u"))
    rows = rows.select("page_id", host(u).alias("host"), path(u).alias("path"), canonical(u).alias("key"))
    text, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    found = is_listed(rows, listed, "key", "url")
    return found.select(
        "page_id", "host", "path", text.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )
