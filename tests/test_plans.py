"""What the physical plans must and must not contain."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.catalog import QUERIES
from tokenloom.catalog.corpus import documents
from tokenloom.operators.bpe import encode_bpe
from tokenloom.operators.prefix import exclusive_prefix
from tokenloom.operators.split import locate_cut, one_split, split_corpus
from tokenloom.sources.archives import list_members

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["training_blocks", "token_chunks", "bpe_token_counts", "mfu_ema", "run_best", "eval_loss"]
)
def test_no_nested_loops(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_split_shuffles_nothing(spark):
    corpus = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    cut = locate_cut(corpus)
    assert "Exchange" not in plan_of(split_corpus(corpus, cut=cut))
    assert f"LessThanOrEqual(doc_id,{cut.doc_id})" in plan_of(one_split(corpus, "train", cut=cut))


def test_byte_pair_encoding_is_map_only(spark):
    ranks = spark.range(256).select(
        F.unhex(F.lpad(F.hex("id"), 2, "0")).alias("token"), F.col("id").cast("int").alias("rank")
    )
    corpus = spark.read.parquet(f"{SF}/documents.parquet").select(F.lit("train").alias("split"), "doc_id", "text")
    plan = plan_of(encode_bpe(corpus, ranks))
    assert "Exchange" not in plan
    assert len(re.findall("ArrowEvalPython", plan)) == 1 and plan.count("encode(") == 1


def test_prefix_shuffles_rows_once(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_id", "value")
    plan = plan_of(
        exclusive_prefix(df, partition=["user_id"], key="event_id", value="value", how="min",
                         out="p", fanout=64)
    )
    assert "Join" not in plan and "SinglePartition" not in plan
    # Two levels of totals and one exchange for each window.
    assert plan.count("Exchange") <= 4


def test_chunks_move_tokens_once_and_through_no_window(spark):
    from tokenloom.operators import chunks

    encoded = spark.createDataFrame(
        [("train", i, 3, [1, 2, 3]) for i in range(9)],
        "split string, doc_id bigint, n_tokens bigint, tokens array<int>",
    )
    for halo in (0, 2):
        plan = plan_of(chunks.pack_chunks(encoded, 4, halo=halo))
        # No join with the positions and no window, whatever the number of documents.
        assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan
    few_large = spark.createDataFrame(
        [("train", i * 10**9, 5000, list(range(5000))) for i in range(3)], encoded.schema
    )
    packed = chunks.pack_chunks(few_large, 4096).orderBy("chunk_id").collect()
    assert [t for r in packed for t in r["tokens"]] == list(range(5000)) * 3


def test_a_document_of_many_shards_is_cut_before_it_moves(spark):
    from tokenloom.operators import chunks

    sizes = [3, 5000, 1, 0, 700, 2]
    rows = [("val", i << 40, n, [i * 10_000 + j for j in range(n)]) for i, n in enumerate(sizes)]
    encoded = spark.createDataFrame(rows, "split string, doc_id bigint, n_tokens bigint, tokens array<int>")
    shards = chunks.divide_stream(encoded, 10, 4, 100)
    assert shards.span == 100 and shards.count == 58
    ids, n = (np.array([r[k] for r in rows if r[2]]) for k in (1, 2))
    row, shard, begin, count = shards.slices("val", ids, n)
    assert count.max() == 104 and count.sum() == 5706 + 57 * 4 and len(row) == len(set(zip(row, shard)))
    packed = chunks.pack_chunks(encoded, 10, halo=4, tokens_per_shard=100).orderBy("chunk_id").collect()
    stream = [t for r in rows for t in r[3]]
    assert [r["tokens"] for r in packed] == [stream[i : i + 10] for i in range(0, 5706, 10)]
    assert [r["halo"] for r in packed] == [stream[i + 10 : i + 14] for i in range(0, 5706, 10)]


def test_documents_that_change_between_two_reads_are_noticed(spark):
    from tokenloom.operators import chunks

    encoded = spark.createDataFrame([("val", 1, 3, [1, 2])], "split string, doc_id bigint, n_tokens bigint, tokens array<int>")
    with pytest.raises(Exception, match="documents have changed"):
        chunks.pack_chunks(encoded, 2).collect()


def test_positions_of_sparse_ids_take_few_shuffles(spark):
    from tokenloom.operators.chunks import token_positions
    from tokenloom.operators.split import document_offsets

    rows = [("train", n << 30, 5) for n in range(3000)]
    encoded = spark.createDataFrame(rows, "split string, doc_id bigint, n_tokens bigint")
    placed = token_positions(encoded)
    assert plan_of(placed).count("Exchange") <= 4
    assert sorted((r["doc_id"], r["start"]) for r in placed.collect()) == [(n << 30, 5 * n) for n in range(3000)]
    corpus = spark.createDataFrame([(n << 30, "ab") for n in range(500)], "doc_id bigint, text string")
    assert plan_of(document_offsets(corpus)).count("Exchange") <= 4
    cut = locate_cut(corpus, 0.33)
    assert (cut.total, cut.position, cut.doc_id, cut.head) == (1000, 330, 165 << 30, 0)


def test_blocks_take_one_key_per_start(spark):
    plan = plan_of(QUERIES["training_blocks_shuffled"](spark, SF))
    assert "Window" not in plan and plan.count("Join") == 1
    # The tokens of the chunks and the starts; below the former only the move to shards.
    assert plan.count("Exchange") == 3


def test_chunks_are_never_broadcast(spark, monkeypatch):
    from tokenloom.operators import blocks
    from tokenloom.operators.blocks import cut_blocks

    starts = spark.range(5).selectExpr("'val' split", "id batch_id", "0 row_id", "id start")
    chunks = spark.range(4).selectExpr("'val' split", "id chunk_id", "array(1, 2, 3, 4) tokens")
    for beside in (chunks, chunks.withColumn("halo", F.col("tokens"))):
        few = cut_blocks(starts, beside, 4)
        assert "BroadcastHashJoin" in plan_of(few) and "BuildRight" in plan_of(few)
        with monkeypatch.context() as patched:
            patched.setattr(blocks, "BROADCAST_DRAWS", 4)
            for many in (cut_blocks(starts, beside, 4), cut_blocks(starts, beside, 4, n_starts=5)):
                assert "SortMergeJoin" in plan_of(many) and "BroadcastExchange" not in plan_of(many)
                assert sorted(many.collect()) == sorted(few.collect())


def test_large_inputs_are_not_spread(spark, monkeypatch):
    from tokenloom.operators import layout

    assert "REPARTITION_BY_NUM" in plan_of(documents(spark, SF))
    monkeypatch.setattr(layout, "SPREAD_BYTES_PER_CORE", 0)
    assert "Exchange" not in plan_of(documents(spark, SF))


def test_listing_archives_reads_no_content(spark, tmp_path):
    (tmp_path / "x.zip").write_bytes(b"PK\x05\x06" + bytes(18))
    plan = plan_of(list_members(spark, str(tmp_path)))
    assert "ReadSchema: struct<>" in plan


def test_tasks_need_no_installed_package(tmp_path):
    """A driver started elsewhere, as the workers' search path does not hold this package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from __spark_entry__ import entry, queries
from tokenloom.session import build_session
spark = build_session("elsewhere", "local[2]", spark__sql__shuffle__partitions="2")
assert entry(spark).count() > 0
assert queries()["bpe_encode"](spark, {SF!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK")
           and not k.startswith("PYSPARK_GATEWAY")}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, timeout=300
    )
    assert done.returncode == 0, done.stderr.decode()[-2000:]
