"""The pipeline against a plain version of its stages."""

import brute
import corpus_pipeline
import oracle
from pyspark.sql import functions as F

from tokenloom.llm import language_id
from tokenloom.llm.queries import PIECES

SF_DIR = f"{oracle.TESTDATA}/sf0.001"


def test_pipeline_equals_plain_stages(spark):
    docs = brute.rows(SF_DIR, "documents")
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    predicted = {r.doc_id: r for r in language_id.identify(table, PIECES).collect()}
    docs = [
        d
        for d in docs
        if predicted[d["doc_id"]].lang_pred != "und" and predicted[d["doc_id"]].score >= language_id.MIN_SCORE
    ]
    docs.sort(key=lambda d: d["doc_id"])
    numbers = brute.components([d["text"] for d in docs])
    docs = [d for i, d in enumerate(docs) if numbers[i] == i]
    items = [r["text"] for r in brute.rows(SF_DIR, "benchmark")]
    bad = {i for i, _ in brute.leaks([d["text"] for d in docs], items)}
    docs = [d for i, d in enumerate(docs) if i not in bad]
    want = {}
    for d in docs:
        text, done = "", 0
        for start, end, _ in brute.secret_spans(d["text"]):
            if start >= done:
                text += d["text"][done:start] + "[secret]"
            done = max(done, end)
        want[d["doc_id"]] = brute.byte_encoding().encode_ordinary(text + d["text"][done:])
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: list(r.ids) for r in found} == want and len(found) == len(want)


def test_stages_take_odd_rows_and_clashing_names(spark):
    names = ["score", "lang_pred", "__id", "__hash", "__bad", "__blob", "__found", "id", "hash", "blob", "leaking", "findings"]
    secret = "my password = hunter2hunter2 stands in this english text and the others do not"
    rows = [(1, None), (2, ""), (3, secret), (3, secret), (None, secret), (4, "x" * 3000), (5, "the cat and the dog " * 400)]
    rows += [(6, "the cat and the dog " * 400 + "too"), (None, None), (7, "1234 !!"), (8, secret + " too")]
    table = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = table.withColumns({c: F.lit("other") for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == [*table.columns, *names]
    kept = sorted((r.doc_id, r.text, r.score) for r in docs.collect())
    # Texts without letters go, and of near copies the one with the smallest id stays.
    marked = secret.replace("password = hunter2hunter2", "[secret]")
    assert kept == [(3, marked, "other"), (4, "x" * 3000, "other"), (5, "the cat and the dog " * 400, "other")]
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id: list(r.ids) for r in encoded} == {i: brute.byte_encoding().encode_ordinary(t) for i, t, _ in kept}


def test_stages_keep_columns_and_take_an_empty_table(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0).withColumn("extra", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, table, SF_DIR)
        assert out.columns == table.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, table, SF_DIR).columns == ["doc_id", "ids"]
