"""Document fingerprints by SpotSigs.

A signature is a chain of content words that follows a common word: every common
word is an anchor, common words within the chain are passed over, and the start
of a line is an anchor too, so that texts without common words have signatures.
A text's fingerprint stands for its set of signatures; likeness is the Jaccard
similarity of two sets.

The edited text and the next document need the neighbour in falling order of
ids.  Ids are cut into buckets at quantiles, which are ids of the table, so the
documents that open a bucket are known by their id and go to the bucket before it as
well; neighbours are then found by a window within each bucket.  Texts are shuffled
once, sets are computed after that.  There are at most ``MOST_BUCKETS`` cuts, found in
two steps of ``STRIDE``; larger tables have larger buckets, which are sorted on disk.
All steps are SQL expressions.

Cases: a null text is empty; an empty text, and one with fewer words than a
chain, has an empty set; two empty sets have likeness 1, an empty and another 0;
rows without an id come last; equal ids are ordered by text; repeated rows each
give their own row; a single document is its own next; extra columns are not
read; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

CHAIN = 2
BUCKET_ROWS, MOST_BUCKETS, STRIDE = 2000, 4096, 64

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to a in is that was for it with as his he on be at by this have from or are an not "
    "le la les de des du un une et est en que qui dans pour par sur au pas plus "
    "der die das den dem und ist zu mit von auf ein eine nicht im für "
    "el los las y del al es por con para no se su lo"
).split()


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """Sorted set of 64-bit signatures of a text."""
    low = F.lower(F.coalesce(text, F.lit("")))
    # A common word becomes a mark in front of the word that follows; so does the start of a line.
    anchored = F.regexp_replace(F.regexp_replace(low, r"(^|\n)\s*", "\n\u0001"), rf"(?<=[\s\u0001])(?:{'|'.join(ANCHORS)})(?:\s+|$)", "\u0001")
    words = F.array_remove(F.split(F.rtrim(anchored, F.lit("\u0001")), r"\s+"), "")
    plain = lambda w: F.translate(w, "\u0001", "")
    whole = lambda ws: F.transform(
        ws, lambda w, i: F.when(w.contains("\u0001") & (i + chain <= F.size(ws)), F.xxhash64(plain(F.array_join(F.slice(ws, i + 1, F.lit(chain)), " ")))))
    # Binding the words through a one-element array splits the text once per row.
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.array(words), whole)[0])))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two signature sets."""
    both, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(both / F.greatest(total - both, F.lit(1)))


def fingerprint(sigs: Column) -> Column:
    """Size of the set and SHA-256 of its members."""
    return F.concat_ws(":", F.size(sigs).cast("string"), F.sha2(F.array_join(F.transform(sigs, lambda x: x.cast("string")), ",").cast("binary"), 256))


def place(key: Column, cuts: list[int]) -> Column:
    """Number of the sorted ``cuts`` below a key: first over every ``STRIDE``-th of them, then within one stride."""
    below = lambda xs: F.size(F.filter(xs, lambda c: c < key))
    coarse = below(F.lit(cuts[STRIDE - 1::STRIDE]).cast("array<bigint>")) * STRIDE
    return coarse + F.transform(F.array(coarse), lambda at: below(F.slice(F.lit(cuts).cast("array<bigint>"), at + 1, F.lit(STRIDE))))[0]


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): every row with the row of the next lower id, the last with the first."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), value.alias("text"))
    key = F.coalesce("doc_id", F.lit(-(1 << 62)))
    ids = rows.select(key.alias("k"))
    n = ids.count()
    parts = min(MOST_BUCKETS, max(1, -(-n // BUCKET_ROWS)))
    found = ids.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [1.0], 20 * parts).alias("c"), F.max("k").alias("top")).first()
    # A cut is an id of the table and the greatest of its bucket; buckets fall with their number.
    cuts = sorted({c for c in found.c if c < found.top}) if n and parts > 1 else []
    last = len(cuts)
    at = place(key, cuts) if cuts else F.lit(0)
    bucket = F.lit(last) - at
    opens = F.coalesce(F.get(F.lit(cuts).cast("array<bigint>"), at) == key, key == F.lit(found.top if n else 0))
    own = F.struct(bucket.alias("bucket"), F.lit(0).alias("guest"))
    # The rows that open a bucket are guests at the end of the one before, those of the first bucket at the end of the last.
    guest = F.struct(F.when(bucket == 0, last).otherwise(bucket - 1).alias("bucket"), F.lit(1).alias("guest"))
    placed = rows.select("*", F.inline(F.when(opens, F.array(own, guest)).otherwise(F.array(own))))
    # Without a number of partitions adaptive execution may join small ones.
    read = placed.repartition("bucket").withColumn("sigs", signatures(F.col("text")))
    order = Window.partitionBy("bucket").orderBy("guest", key.desc(), F.col("text"))
    both = read.withColumn("_next", F.lead(F.struct("text", "sigs")).over(order)).where("guest = 0")
    return both.select("doc_id", "text", "sigs", F.col("_next.text").alias("next_text"), F.col("_next.sigs").alias("next_sigs"))


def compare(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its signature set, its edited text with that text's set, and the likeness to it and to the next document."""
    size = F.length("text")
    half = F.floor(size / 2).cast("int")
    rows = with_next(docs, doc_id, text)
    edited = F.concat(F.substring("text", F.lit(1), size - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sigs", signatures(F.col("edited")))
    return rows.select(
        "doc_id", size.cast("long").alias("n_chars"), "edited", "sigs", "edited_sigs",
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )
