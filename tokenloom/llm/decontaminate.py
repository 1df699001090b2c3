"""Benchmark decontamination by MinHash containment with one bottom-hash filter, in DataFrame functions only.

An item is contained in a document when at least `threshold` of the item's distinct word
shingles occur in it, however long the document is. MinHash orders all shingles by one hash. An
item of q shingles is represented by its bottom floor((1 - threshold) * q) + 1 hashes: a
containing document misses fewer shingles than that, so it shares one of them, and nothing is
lost. That exact filter replaces a search by partitions of item sizes: the size class only groups
the counts, and hashes are joined without it. Only shingles at or under the largest such hash of
all items leave the documents. Pairs that meet are verified by exact shingle containment on the words.

Words and shingles are as for the similarity join: runs of characters other than U+0020 and
U+0009 to U+000D, A-Z as a-z; five words, or the whole sequence where there are fewer.

Defined cases: a null or blank text, of a document or an item, contains and is contained in
nothing; texts are judged by content, so equal texts share their verdict and each row of them is
reported; an item shorter than five words is found only in a document with the same words;
empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import free_names, small_side, stored

WIDTH = 5
THRESHOLD = 0.75
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    pieces = F.split(F.translate(text, UPPER, LOWER), r"[\x20\x09-\x0D]+")
    return F.filter(pieces, lambda w: w != "")


def _starts(words: str, width: int) -> Column:
    """0-based first words of the shingles of a word array column."""
    n = F.size(words)
    none = F.array().cast("array<int>")
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).otherwise(none)


def hashed_shingles(df: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(key, hashes): the hash of every shingle, repeats included.

    Words are hashed once; a shingle hashes its words' hashes (absent ones are skipped).
    """
    words = df.select(key, F.transform(word_array(F.col(text)), lambda w: F.xxhash64(w)).alias("__w"))
    w = F.col("__w")
    shingle = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    return words.select(key, F.transform(_starts("__w", width), shingle).alias("hashes"))


def exact_shingles(df: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(key, shingle): the distinct shingles as words."""
    words = df.select(key, word_array(F.col(text)).alias("__w"))
    joined = lambda i: F.array_join(F.slice("__w", i + 1, width), " ")
    listed = words.select(key, F.transform(_starts("__w", width), joined).alias("__s"))
    return listed.select(key, F.explode(F.array_distinct("__s")).alias("shingle"))


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def item_sketches(items: DataFrame, threshold: float) -> DataFrame:
    """(item, size_class, hash): the bottom hashes of (item, text) rows."""
    sets = hashed_shingles(items, "item", "text").select(
        "item", F.array_distinct("hashes").alias("hashes")
    )
    q = F.size("hashes")
    # The allowance keeps floor() right where (1 - threshold) * q is a whole number.
    least = F.floor(q * F.lit(1.0 - threshold) + 1e-9).cast("int") + 1
    bottom = F.slice(F.array_sort("hashes"), 1, least)
    return sets.filter(q > 0).select(
        "item", F.floor(F.log2(q)).cast("int").alias("size_class"), F.explode(bottom).alias("hash")
    )


def find_leaks(
    docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, item_id, shared, item_shingles, containment) of every contained item.

    `docs` has doc_id and text, `items` item_id and text.
    """
    tests = items.select(text_key(F.col("text")).alias("item"), "text").dropDuplicates(["item"])
    sketches = stored(item_sketches(tests, threshold), "sketches")
    bounds = sketches.groupBy("size_class").agg(F.count("*").alias("n"), F.max("hash").alias("top")).collect()
    rows, top = sum(b["n"] for b in bounds), max((b["top"] for b in bounds), default=None)

    texts = docs.select(text_key(F.col("text")).alias("doc"), "text")
    offered = hashed_shingles(texts, "doc", "text").select(
        "doc", F.explode(F.filter("hashes", lambda h: h <= F.lit(top))).alias("hash")
    )
    pairs = stored(
        offered.join(small_side(sketches.select("item", "hash"), rows), "hash")
        .select("doc", "item")
        .distinct(),
        "leak-candidates",
    )
    suspects = pairs.select("doc").distinct()
    suspect_texts = texts.join(small_side(suspects, suspects.count()), "doc", "left_semi")
    own = exact_shingles(suspect_texts.dropDuplicates(["doc"]), "doc", "text")
    wanted = exact_shingles(tests, "item", "text")
    sizes = wanted.groupBy("item").agg(F.count("*").alias("item_shingles"))
    shared = (
        own.join(small_side(wanted, wanted.count()), "shingle")
        .groupBy("doc", "item")
        .agg(F.count("*").alias("shared"))
        .join(pairs, ["doc", "item"])
        .join(sizes, "item")
        .withColumn("containment", F.col("shared") / F.col("item_shingles"))
        .filter(F.col("containment") >= threshold)
    )
    leaks = stored(shared, "leaks")
    ids = docs.select("doc_id", text_key(F.col("text")).alias("doc"))
    names = items.select("item_id", text_key(F.col("text")).alias("item"))
    return (
        ids.join(small_side(leaks, leaks.count()), "doc")
        .join(names, "item")
        .select("doc_id", "item_id", "shared", "item_shingles", "containment")
    )


def drop_leaks(docs: DataFrame, items: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the documents that contain an item."""
    found = find_leaks(
        docs.select(text_key(F.col("text")).alias("doc_id"), "text"), items, threshold=threshold
    )
    (name,) = free_names(docs, "leaking")
    bad = stored(found.select(F.col("doc_id").alias(name)).distinct(), "leaking")
    key = text_key(F.col("text"))
    return docs.join(small_side(bad, bad.count()), key == F.col(name), "left_anti")
