"""Spelling variants by generating one-edit neighbourhoods over a reduced alphabet.

1. Words. Runs of letters are counted over whole texts; those of at least MIN_LENGTH code points and
   MIN_COUNT occurrences are the vocabulary.
2. Reduction. Every letter is hashed to one of a few symbols, so a word becomes a reduced word.
   One edit of a word is at most one edit of its reduced word. The fewest symbols are taken with
   which the vocabulary has half as many reduced words as words.
3. Generation. For every distinct reduced word its full neighbourhood is generated: itself, all
   deletions, insertions and replacements, as rolling hashes. Those that are in no case a reduced
   word of the vocabulary are left out by a bitmap of fixed size before anything is shuffled.
4. Join of the rest with the reduced vocabulary, then verification: pairs of words at edit
   distance one in their original letters. Joins of words shuffle both sides.
5. A word's form is its most frequent near word, if that is FORM_RATIO times as frequent; roots
   follow forms by pointer doubling.

Reduced words are compared by 64-bit hashes: a collision only adds a pair that verification
drops.

Defined cases: a null text has no words; a null doc_id counts as the empty string in the hash
that deletes code points; repeated rows count each; equally frequent near words: the smaller one
in code-point order; a text or word of any length is whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import python_tasks, stored
from tokenloom.llm.shingles import BASE, INVERSE, mixed

MIN_LENGTH = 5
MIN_COUNT = 3
FORM_RATIO = 2
# One run in SLIP_EVERY (by its hash) is counted with a code point less.
SLIP_EVERY = 97
UPPER = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]))
SYMBOLS = "abcdefghijklmnop"
SIZES = (4, 6, 8, 12, 16)
# The bitmap of reduced words has at least 16 bits a word, up to 2**MOST_BITS bits (16 MB) in all.
MOST_BITS = 27
# Neighbours worked on at once.
AT_ONCE = 1 << 20


def slipped(doc_id: Column, run: Column) -> Column:
    """`run`, without one code point where the hash of `<doc_id>:<run>` asks for it."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run)
    h = F.crc32(key.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % SLIP_EVERY == 0, cut).otherwise(run)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the vocabulary."""
    lowered = F.translate("text", UPPER, UPPER.lower())
    runs = docs.select("doc_id", F.explode(F.split(lowered, f"[^{LETTERS[:26]}À-ÿ]+")).alias("run"))
    # A slip only shortens, so shorter runs cannot become words.
    words = runs.filter(F.char_length("run") >= MIN_LENGTH).select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.filter(F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= MIN_COUNT)


def reduced(word: Column, symbols: int) -> Column:
    to = [SYMBOLS[(ord(c) * 0x9E3779B1 >> 12) % symbols] for c in LETTERS]
    return F.translate(word, LETTERS, "".join(to))


def choose_symbols(vocabulary: DataFrame, n: int) -> int:
    """The fewest symbols that give half as many reduced words as words."""
    counts = vocabulary.agg(*[F.approx_count_distinct(reduced(F.col("word"), k)) for k in SIZES]).first()
    return next((k for k, codes in zip(SIZES, counts) if 2 * codes >= n), SIZES[-1])


def _matrices(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, symbols as numbers from 1) of the words of each length, in blocks."""
    names = words.to_pylist()
    lengths = np.array([len(w) for w in names], dtype=np.int64)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        step = max(1, AT_ONCE // (2 * len(SYMBOLS) * (int(length) + 1)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            data = np.frombuffer("".join([names[i] for i in part]).encode("ascii"), np.uint8)
            yield part, data.reshape(len(part), int(length)).astype(np.uint64) - np.uint64(ord("a") - 1)


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n, BASE, dtype=np.uint64))])


def hashes(words: pa.Array) -> np.ndarray:
    """The hash of each reduced word."""
    out = np.zeros(len(words), dtype=np.uint64)
    for rows, v in _matrices(words):
        out[rows] = (v * _powers(v.shape[1])[: v.shape[1]]).sum(axis=1, dtype=np.uint64)
    return mixed(out)


def neighbours(v: np.ndarray, symbols: int, at: np.ndarray) -> np.ndarray:
    """Hashes of the edits of each row of `v` at the positions `at`, and of the row itself."""
    m, n = v.shape
    power = _powers(n)
    before = np.zeros((m, n + 1), dtype=np.uint64)
    np.cumsum(v * power[:n], axis=1, out=before[:, 1:])
    whole = before[:, -1:]
    alphabet = np.arange(1, symbols + 1, dtype=np.uint64)
    inserted = (before[:, at] + (whole - before[:, at]) * BASE)[:, :, None] + power[at][None, :, None] * alphabet
    at = at[at < n]
    deleted = before[:, at] + (whole - before[:, at + 1]) * INVERSE
    replaced = (whole - v[:, at] * power[at])[:, :, None] + power[at][None, :, None] * alphabet
    return mixed(np.concatenate([whole, deleted, inserted.reshape(m, -1), replaced.reshape(m, -1)], axis=1))


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes = hashes(b["reduced"]).view(np.int64)
        yield pa.record_batch([b["word"], b["n"], b["reduced"], pa.array(codes)], ["word", "n", "reduced", "code"])


def _generate(symbols: int, bitmap, bits: int):
    """(code, near): the generated neighbours that may be reduced words of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap.value, dtype=np.uint8)
        low = np.uint64((1 << bits) - 1)
        for b in batches:
            for _, v in _matrices(b["reduced"]):
                m, n = v.shape
                own = mixed((v * _powers(n)[:n]).sum(axis=1, dtype=np.uint64))
                codes, nears = [], []
                step = max(1, AT_ONCE // (2 * symbols * m))
                for at in range(0, n + 1, step):
                    near = neighbours(v, symbols, np.arange(at, min(at + step, n + 1)))
                    place = near & low
                    hit = known[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1
                    rows, columns = np.nonzero(hit)
                    codes.append(own[rows])
                    nears.append(near[rows, columns])
                pairs = np.unique(np.stack([np.concatenate(codes), np.concatenate(nears)]), axis=1).view(np.int64)
                yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["code", "near"])

    return run


def _bitmap(codes: DataFrame, bits: int) -> bytes:
    """A bitmap of 2**bits bits with the low bits of every code set; at most 2**MOST_BITS bits."""
    place = F.col("code").bitwiseAND((1 << bits) - 1)
    words = codes.select(
        F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, cast(code & 63 as int))").alias("bit")
    )
    rows = words.groupBy("at").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()
    out = np.zeros(1 << bits - 6, dtype="<i8")
    out[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return out.tobytes()


def _shuffled(df: DataFrame) -> DataFrame:
    """`df` as a side of a join that shuffles both sides. Spark reckons stored words by their
    compressed files and generated neighbours as no more than the words they come from, so it
    would take tables of any size for small ones and collect them on the driver."""
    return df.hint("merge")


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, m): every two words of (word, n) at edit distance one, both ways."""
    spark = vocabulary.sparkSession
    python_tasks(spark)
    symbols = choose_symbols(vocabulary, vocabulary.count())
    coded = stored(
        vocabulary.select("word", "n", reduced(F.col("word"), symbols).alias("reduced")).mapInArrow(
            _coded, "word string, n bigint, reduced string, code bigint"
        ),
        "reduced-words",
    )
    codes = stored(coded.groupBy("code").agg(F.first("reduced").alias("reduced")), "reduced-vocabulary")
    bits = min(MOST_BITS, max(10, (16 * codes.count()).bit_length()))
    bitmap = spark.sparkContext.broadcast(_bitmap(codes, bits))
    pairs = codes.select("reduced").mapInArrow(_generate(symbols, bitmap, bits), "code bigint, near bigint")
    words = coded.select("code", "word", "n")
    others = coded.select(F.col("code").alias("near"), F.col("word").alias("other"), F.col("n").alias("m"))
    return (
        pairs.join(_shuffled(words), "code")
        .join(_shuffled(others), "near")
        .filter(F.levenshtein("word", "other", 1) == 1)
        .select("word", "n", F.col("other").alias("near"), "m")
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, from (word, form), in doubling steps."""
    current = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = current.join(_shuffled(ahead), "root", "left")
        moved = stored(joined.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("open")), "roots")
        current = moved.drop("open")
        if not moved.filter("open").limit(1).count():
            return current


def group_variants(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary of (doc_id, text)."""
    vocabulary = stored(count_words(docs), "vocabulary")
    best = F.min(F.struct((-F.col("m")).alias("m"), "near"))
    found = near_words(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.m") >= FORM_RATIO * F.col("n")
    formed = stored(
        vocabulary.join(_shuffled(found), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.m")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.filter("form is not null"))
    return formed.join(_shuffled(roots), "word", "left").withColumn("root", F.coalesce("root", "word"))
