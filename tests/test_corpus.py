"""Split, vocabulary, chunks and blocks on hand-worked and random cases."""

import random

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.arrays import (
    append_id,
    chunk_array,
    flatten_once,
    keep_last,
    last_element,
)
from tokenloom.operators.blocks import cut_blocks, draw_starts
from tokenloom.operators.chunks import count_tokens, pack_chunks, token_positions, unpack_chunks
from tokenloom.operators.filters import remove_rows
from tokenloom.operators.prefix import exclusive_prefix
from tokenloom.operators.split import (
    count_characters,
    document_offsets,
    locate_cut,
    one_split,
    split_corpus,
)
from tokenloom.operators.vocab import (
    build_vocab,
    char_decoder,
    encode_chars,
    lookup_ids,
    narrow_id,
    vocab_maps,
    vocab_size,
)


def corpus_of(spark, texts, ids=None):
    ids = ids if ids is not None else range(len(texts))
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id bigint, text string")


def split_texts(pieces):
    out = {"train": "", "val": ""}
    for row in sorted(pieces.collect(), key=lambda r: r["doc_id"]):
        out[row["split"]] += row["text"]
    return out


@pytest.mark.parametrize(
    "texts, ratio, train, val",
    [
        (["abcdefghij"], 0.9, ["abcdefghi"], ["j"]),
        (["abc", "defghij"], 0.5, ["abc", "de"], ["fghij"]),
        (["a" * 100], 0.29, ["a" * 28], ["a" * 72]),
        (["abc", "", "def"], 0.5, ["abc"], ["def"]),
        (["abc"], 1.0, ["abc"], []),
        (["abc"], 0.0, [], ["abc"]),
        ([], 0.9, [], []),
        (["", ""], 0.9, [], []),
        (["😀é", "b\n"], 0.3, ["😀"], ["é", "b\n"]),
    ],
)
def test_split(spark, texts, ratio, train, val):
    rows = split_corpus(corpus_of(spark, texts), ratio).orderBy("doc_id").collect()
    assert [r["text"] for r in rows if r["split"] == "train"] == train
    assert [r["text"] for r in rows if r["split"] == "val"] == val


@pytest.mark.parametrize("seed", range(2))
def test_split_of_random_corpora(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample(range(-2000, 2000), 60)
    texts = ["".join(rng.choices("ab é😀\n", k=rng.choice([0, 1, 7, 40]))) for _ in ids]
    whole = "".join(text for _, text in sorted(zip(ids, texts)))
    ratio = rng.random()
    corpus = corpus_of(spark, texts, ids).repartition(rng.choice([1, 3, 8]))
    for fanout in (16, 1024):
        cut = locate_cut(corpus, ratio, rows_per_range=fanout)
        assert (cut.total, cut.position) == (len(whole), int(len(whole) * ratio))
        got = split_texts(split_corpus(corpus, cut=cut))
        assert got == {"train": whole[: cut.position], "val": whole[cut.position :]}
    for name in ("train", "val"):
        assert split_texts(one_split(corpus, name, cut=cut))[name] == got[name]
    starts = {r["doc_id"]: r["start"] for r in document_offsets(corpus).collect()}
    position = 0
    for doc_id, text in sorted(zip(ids, texts)):
        assert starts[doc_id] == position
        position += len(text)
    assert count_characters(corpus).first()[0] == len(whole)


def test_length_column_saves_reading_text(spark):
    corpus = corpus_of(spark, ["abc", "defghij"]).withColumn("n_chars", F.char_length("text"))
    assert locate_cut(corpus, 0.5, length=F.col("n_chars")) == locate_cut(corpus, 0.5)


@pytest.mark.parametrize("how, python", [("sum", sum), ("min", min), ("max", max)])
def test_prefix_levels_equal_a_plain_loop(spark, how, python):
    rng = random.Random(how)
    # One partition holds most rows; null is a partition of its own.
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), k, rng.randint(-50, 50))
            for k in rng.sample(range(-2000, 2000), 300)]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    for fanout in (16, 65536):
        got = exclusive_prefix(
            df, partition=["g"], key="k", value="v", how=how, out="p", fanout=fanout
        ).collect()
        assert len(got) == len(rows)
        for row in got:
            before = [v for g, k, v in rows if g == row["g"] and k < row["k"]]
            assert row["p"] == (python(before) if before else None)


def test_vocabulary(spark):
    corpus = corpus_of(spark, ["ba😀é\n", "ab", None])
    vocab = build_vocab(corpus)
    rows = [tuple(r) for r in vocab.orderBy("id").collect()]
    assert rows == [(0, "\n"), (1, "a"), (2, "b"), (3, "é"), (4, "😀")]
    assert vocab_size(vocab).first()[0] == 5
    maps = vocab_maps(vocab).first()
    assert maps["stoi"] == {ch: i for i, ch in rows} and maps["itos"] == dict(rows)
    encoded = encode_chars(corpus, vocab)
    tokens = {r["doc_id"]: r["tokens"] for r in encoded.collect()}
    assert tokens == {0: [2, 1, 4, 3, 0], 1: [1, 2], 2: None}
    decoded = encoded.select("doc_id", char_decoder(vocab)("tokens").alias("text"))
    assert {r["doc_id"]: r["text"] for r in decoded.collect()} == {0: "ba😀é\n", 1: "ab", 2: None}
    chars = spark.createDataFrame([("b",), ("é",)], "ch string")
    assert sorted(tuple(r) for r in lookup_ids(chars, vocab).collect()) == [("b", 2), ("é", 3)]


def test_unknown_character_is_an_error(spark):
    vocab = build_vocab(corpus_of(spark, ["ac"]))
    for text in ("b", "😀"):
        with pytest.raises(Exception, match="not in the vocabulary"):
            encode_chars(corpus_of(spark, [text]), vocab).collect()


def test_ids_never_wrap(spark):
    ids = spark.createDataFrame([(65535,)], "t bigint")
    assert ids.select(narrow_id(F.col("t"))).first()[0] == 65535
    with pytest.raises(Exception, match="out of range"):
        ids.select(narrow_id(F.col("t") + 1)).collect()


@pytest.mark.parametrize("size", [1, 4, 50])
def test_chunks_and_blocks(spark, size):
    rng = random.Random(size)
    docs = [(s, d, [rng.randrange(9) for _ in range(rng.choice([0, 1, 2, 30]))])
            for s in ("train", "val") for d in rng.sample(range(1000), 12)]
    streams = {s: [t for _, _, ts in sorted(d for d in docs if d[0] == s) for t in ts]
               for s in ("train", "val")}
    df = spark.createDataFrame(docs, "split string, doc_id bigint, tokens array<int>")
    df = df.withColumn("n_tokens", F.size("tokens").cast("bigint"))
    assert {r[0]: r[1] for r in count_tokens(df).collect()} == {
        s: len(t) for s, t in streams.items()
    }
    assert token_positions(df).count() == len(docs)
    chunks = pack_chunks(df, size, tokens_per_shard=4 * size)
    got = {}
    for row in chunks.orderBy("split", "chunk_id").collect():
        got.setdefault(row["split"], []).append((row["chunk_id"], row["tokens"]))
    for split, stream in streams.items():
        want = [stream[i : i + size] for i in range(0, len(stream), size)]
        assert got.get(split, []) == list(enumerate(want))
    flat = unpack_chunks(chunks, size).orderBy("split", "pos").collect()
    assert [r["token_id"] for r in flat] == streams["train"] + streams["val"]

    streams = {s: t for s, t in streams.items() if len(t) > size}
    rows = [(s, 0, n, start) for s, t in streams.items()
            for n, start in enumerate(range(len(t) - size))]
    if not rows:
        return
    starts = spark.createDataFrame(rows, "split string, batch_id bigint, row_id int, start bigint")
    wide = pack_chunks(df, 3 * size, halo=size, tokens_per_shard=7 * size)
    for n_starts, packed, chunk_size in ((None, chunks, size), (len(rows), chunks, size), (None, wide, 3 * size), (9, wide, 3 * size)):
        blocks = cut_blocks(starts, packed, size, chunk_size=chunk_size, n_starts=n_starts).collect()
        assert len(blocks) == len(rows)
        for b in blocks:
            stream = streams[b["split"]]
            assert b["x"] == stream[b["start"] : b["start"] + size]
            assert b["y"] == stream[b["start"] + 1 : b["start"] + 1 + size]


def test_draws(spark):
    def drawn(**kw):
        return draw_starts(spark, {"train": 10}, block_size=4, batch_size=6, batches=50, **kw)

    rows = drawn(seed=1).collect()
    assert {r["start"] for r in rows} == set(range(6))
    assert len({(r["batch_id"], r["row_id"]) for r in rows}) == 300
    assert rows == drawn(seed=1).collect()
    assert rows != drawn(seed=2).collect()
    with pytest.raises(ValueError, match="too few"):
        draw_starts(spark, {"train": 4}, block_size=4, batch_size=1, batches=1)


def test_array_helpers(spark):
    one = spark.range(1)

    def value(expr):
        return one.select(F.expr(expr) if isinstance(expr, str) else expr).first()[0]

    seven = F.array(*[F.lit(i) for i in range(1, 8)])
    assert value(chunk_array(seven, 3)) == [[1, 2, 3], [4, 5, 6], [7]]
    assert value(chunk_array(F.array().cast("array<int>"), 3)) == []
    nested = F.expr("array(array(1,2), array(), array(3))")
    assert value(flatten_once(nested)) == [1, 2, 3]
    holes = F.expr("array(array(1), null)")
    assert value(flatten_once(holes)) is None
    assert value(flatten_once(holes, skip_nulls=True)) == [1]
    assert value(keep_last(F.slice(seven, 1, 5), 3)) == [3, 4, 5]
    assert value(keep_last(F.slice(seven, 1, 2), 3)) == [1, 2]
    assert value(append_id(F.slice(seven, 1, 2), F.lit(9))) == [1, 2, 9]
    assert value(last_element(seven)) == 7


def test_remove_rows(spark):
    rows = spark.createDataFrame([("Foo",), ("bar",), (None,), ("ÄRGER",)], "t string")

    def kept(words):
        return [r[0] for r in remove_rows(rows, "t", words).collect()]

    assert kept(["FOO"]) == ["bar", None, "ÄRGER"]
    assert kept([]) == ["Foo", "bar", None, "ÄRGER"]
    assert kept(["^b", "är"]) == ["Foo", None]
    assert kept(["(o)\\1", "x"]) == ["bar", None, "ÄRGER"]


def test_tasks_get_small_batches_of_text(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from tokenloom.operators.chunks import pack_chunks
    from tokenloom.operators.vocab import char_decoder, encode_chars

    key = "spark.sql.execution.arrow.maxBytesPerBatch"

    @F.arrow_udf("long")
    def batch_bytes(texts: pa.Array) -> pa.Array:
        return pa.array([texts.nbytes] * len(texts))

    vocab = spark.createDataFrame([(0, "x")], "id int, ch string")
    texts = spark.range(0, 2000, 1, 1).select(F.lit("val").alias("split"), F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10_000).alias("text"))
    encoded = encode_chars(texts, vocab)
    uses = [lambda: encode_chars(texts, vocab), lambda: char_decoder(vocab), lambda: pack_chunks(encoded.limit(0), 4)]
    for use in uses:
        spark.conf.unset(key)
        use()
        assert texts.agg(F.max(batch_bytes("text"))).first()[0] < 5 << 20
