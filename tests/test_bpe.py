"""Byte-pair encoding against an independent implementation with the same ranks."""

import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from tokenloom.operators.bpe import (
    Merger,
    bpe_token_counts,
    encode_bpe,
    merger_of,
    piece_counts,
    piece_dictionary,
    pretokens,
)

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BYTES = {bytes([i]): i for i in range(256)}
SMALL = {**BYTES, b"th": 256, b"the": 257, b" the": 258}


def random_ranks(rng, alphabet=b"abc \n\xc3\xa9", size=60):
    ranks = dict(BYTES)
    while len(ranks) < 256 + size:
        pair = rng.choice(list(ranks)[256:] or list(BYTES)) + bytes([rng.choice(alphabet)])
        left, right = rng.choice(alphabet), rng.choice(alphabet)
        ranks.setdefault(rng.choice([pair, bytes([left, right])]), len(ranks))
    return ranks


def reference(ranks):
    return tiktoken.Encoding("x", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def rank_table(spark, ranks):
    rows = [(bytearray(t), r) for t, r in ranks.items()]
    return spark.createDataFrame(rows, "token binary, rank int")


def encoded(spark, texts, ranks):
    df = spark.createDataFrame(
        [("train", i, t) for i, t in enumerate(texts)], "split string, doc_id bigint, text string"
    )
    rows = encode_bpe(df, rank_table(spark, ranks)).collect()
    assert all(r["n_tokens"] == (len(r["tokens"]) if r["tokens"] is not None else r["n_tokens"])
               for r in rows)
    return {r["doc_id"]: r["tokens"] for r in rows}


def test_hand_worked(spark):
    got = encoded(spark, ["the the other\n\nx", "", "a\n\nb"], SMALL)
    assert got[0] == [257, 258, 32, 111, 257, 114, 10, 10, 120]
    assert got[1] == []
    pieces = spark.createDataFrame([("a\n\nb",)], "t string").select(pretokens(F.col("t"))).first()[0]
    assert pieces == ["a", "\n", "\n", "b"]


@pytest.mark.parametrize("seed", range(3))
def test_random_text(spark, seed):
    rng = random.Random(seed)
    ranks = random_ranks(rng)
    alphabet = list("aabbcc  \n\t'sé1😀.,　 ")
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(200))) for _ in range(80)]
    want = {i: ids for i, ids in enumerate(map(reference(ranks).encode_ordinary, texts))}
    assert encoded(spark, texts, ranks) == want


def test_long_pieces_and_special_tokens(spark):
    rng = random.Random(5)
    ranks = random_ranks(rng)
    texts = ["".join(rng.choices("abcé", k=30_000)), "<|endoftext|> a", " " * 5000 + "a", "a" * 9999]
    want = {i: ids for i, ids in enumerate(map(reference(ranks).encode_ordinary, texts))}
    assert encoded(spark, texts, ranks) == want


def test_merge_equals_the_simple_loop():
    def simple(ranks, raw):
        if raw in ranks:
            return [ranks[raw]]
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not pairs:
                return [ranks[p] for p in parts]
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    for seed in range(200):
        rng = random.Random(seed)
        ranks = random_ranks(rng, alphabet=b"ab", size=rng.randrange(1, 20))
        raw = bytes(rng.choices(b"ab", k=rng.randrange(1, 40)))
        assert Merger(ranks).merge(raw) == simple(ranks, raw)


def test_dictionary_and_counts(spark):
    df = spark.createDataFrame(
        [("train", 0, "the other the the"), ("val", 1, "the\n")],
        "split string, doc_id bigint, text string",
    )
    ranks = rank_table(spark, SMALL)
    counts = {(r["split"], r["piece"]): r["n"] for r in piece_counts(df).collect()}
    assert counts == {("train", "the"): 1, ("train", " the"): 2, ("train", " other"): 1,
                      ("val", "the"): 1, ("val", "\n"): 1}
    ids = {r["piece"]: r["ids"] for r in
           piece_dictionary(piece_counts(df).select("piece").distinct(), ranks).collect()}
    assert ids["the"] == [257] and ids[" other"] == [32, 111, 257, 114]
    assert {r[0]: r[1] for r in bpe_token_counts(piece_counts(df), ranks).collect()} == {"train": 7, "val": 2}


def test_rank_table_is_bounded(spark):
    big = spark.range(70_000).select(
        F.col("id").cast("string").cast("binary").alias("token"), F.col("id").cast("int").alias("rank")
    )
    with pytest.raises(ValueError):
        merger_of(big)
