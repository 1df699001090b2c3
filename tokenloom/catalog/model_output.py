"""Queries over `embeddings` as logits and `conversations` as growing sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.catalog.registry import query, table
from tokenloom.functions.arrays import append_id, keep_last, last_element
from tokenloom.functions.core import hashed_uniform
from tokenloom.functions.logits import keep_top_k, next_id, scale, softmax
from tokenloom.functions.text import characters
from tokenloom.operators.evaluation import batch_losses, row_losses, split_losses
from tokenloom.operators.layout import spread_small
from tokenloom.plans.generate import generate_step, model_context

SEED = 7
TEMPERATURE = 0.8
TOP_K = 10
CONTEXT = 32

LOSS_SQL = """
WITH logits AS (
  SELECT CASE WHEN vec_id % 10 < 9 THEN 'train' ELSE 'val' END AS split, vec_id // 40 AS batch_id,
         vec_id AS row_id, list_transform(embedding, lambda x: x::DOUBLE) AS l,
         CASE WHEN vec_id % 7 = 0 OR vec_id // 40 = 3 THEN -1 ELSE label END AS target
  FROM embeddings
), losses AS (
  SELECT split, batch_id, row_id, target,
         CASE WHEN target <> -1 THEN
           list_max(l) + ln(list_sum(list_transform(l, lambda x: exp(x - list_max(l)))))
           - l[target + 1] END AS loss
  FROM logits
), batches AS (
  SELECT split, batch_id, avg(loss) AS loss FROM losses GROUP BY split, batch_id
)
"""

SOFTMAX_SQL = """
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / 0.8::DOUBLE) AS l FROM embeddings
), masked AS (
  SELECT vec_id, l, list_transform(l, lambda x: CASE
           WHEN x < list_reverse_sort(l)[least(10, len(l))] THEN 0.0::DOUBLE
           ELSE exp(x - list_max(l)) END) AS w
  FROM scaled
), probabilities AS (
  SELECT vec_id, list_transform(w, lambda x: x / list_sum(w)) AS p FROM masked
)
"""


def logits_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec = F.col("vec_id")
    batch = F.expr("vec_id div 40")
    ignored = (vec % 7 == 0) | (batch == 3)
    return spread_small(table(spark, sf_dir, "embeddings"), "vec_id").select(
        F.when(vec % 10 < 9, "train").otherwise("val").alias("split"),
        batch.alias("batch_id"),
        vec.alias("row_id"),
        F.col("embedding").alias("logits"),
        F.when(ignored, -1).otherwise(F.col("label")).alias("target"),
    )


@query(
    "row_loss",
    LOSS_SQL + "SELECT split, batch_id, row_id, target, round(loss, 6) AS loss FROM losses",
)
def row_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    losses = row_losses(logits_table(spark, sf_dir))
    return losses.drop("logits").withColumn("loss", F.round("loss", 6))


@query("batch_loss", LOSS_SQL + "SELECT split, batch_id, round(loss, 6) AS loss FROM batches")
def batch_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_losses(logits_table(spark, sf_dir)).withColumn("loss", F.round("loss", 6))


@query(
    "eval_loss",
    LOSS_SQL
    + "SELECT split, round(avg(loss), 6) AS loss, count(*)::BIGINT AS batches FROM batches GROUP BY split",
)
def eval_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_losses(logits_table(spark, sf_dir)).withColumn("loss", F.round("loss", 6))


@query(
    "topk_ties",
    """
WITH rounded AS (
  SELECT vec_id, list_transform(embedding, lambda x: round(x::DOUBLE, 1)) AS l FROM embeddings
)
SELECT vec_id, list_transform(l, lambda x: CASE
         WHEN x < list_reverse_sort(l)[least(10, len(l))] THEN NULL ELSE x END) AS kept,
       len(list_filter(l, lambda x: x >= list_reverse_sort(l)[least(10, len(l))]))::BIGINT AS n_kept
FROM rounded""",
)
def topk_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rounded = F.transform(F.col("embedding"), lambda x: F.round(x.cast("double"), 1))
    minus_infinity = F.lit(float("-inf"))
    masked = table(spark, sf_dir, "embeddings").select(
        "vec_id", keep_top_k(rounded, TOP_K).alias("masked")
    )
    return masked.select(
        "vec_id",
        F.transform("masked", lambda x: F.when(x != minus_infinity, x)).alias("kept"),
        F.size(F.filter("masked", lambda x: x != minus_infinity)).cast("bigint").alias("n_kept"),
    )


@query(
    "softmax",
    SOFTMAX_SQL
    + "SELECT vec_id, list_transform(p, lambda x: round(x, 6)) AS probabilities FROM probabilities",
)
def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = softmax(keep_top_k(scale(F.col("embedding"), TEMPERATURE), TOP_K))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform(p, lambda x: F.round(x, 6)).alias("probabilities")
    )


@query(
    "softmax_draw",
    SOFTMAX_SQL
    + f"""
, uniform AS (
  SELECT vec_id, p, ('0x' || substr(md5('{SEED}:' || vec_id), 1, 13))::BIGINT::DOUBLE
                    / 4503599627370496::DOUBLE AS u FROM probabilities
)
SELECT vec_id, (coalesce(
         list_min(list_filter(range(0, len(p)), lambda i: list_sum(list_slice(p, 1, i + 1)) > u)),
         list_max(list_filter(range(0, len(p)), lambda i: p[i + 1] > 0))))::INTEGER AS next_id
FROM uniform""",
)
def softmax_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    uniform = hashed_uniform(SEED, F.col("vec_id"))
    drawn = next_id(F.col("embedding"), uniform, temperature=TEMPERATURE, top_k=TOP_K)
    return spread_small(table(spark, sf_dir, "embeddings"), "vec_id").select(
        "vec_id", drawn.alias("next_id")
    )


@query(
    "context_append_crop",
    f"""
SELECT conv_id, turn, list_append(ids, turn) AS grown, list_slice(list_append(ids, turn),
         greatest(len(ids) + 1 - {CONTEXT}, 0) + 1, len(ids) + 1) AS context, ids[-1] AS last_id
FROM (SELECT conv_id, turn, list_transform(string_split(text, ''), lambda c: ord(c)::BIGINT) AS ids
      FROM conversations)""",
)
def context_append_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(characters(F.col("text")), lambda c: F.ascii(c).cast("bigint"))
    grown = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", ids.alias("ids")
    ).select("conv_id", "turn", "ids", append_id(F.col("ids"), F.col("turn")).alias("grown"))
    return grown.select(
        "conv_id",
        "turn",
        "grown",
        keep_last(F.col("grown"), CONTEXT).alias("context"),
        last_element(F.col("ids")).alias("last_id"),
    )


@query(
    "generation_step",
    SOFTMAX_SQL
    + f"""
, uniform AS (
  SELECT vec_id, p, ('0x' || substr(md5('{SEED}:3:' || vec_id), 1, 13))::BIGINT::DOUBLE
                    / 4503599627370496::DOUBLE AS u FROM probabilities
), drawn AS (
  SELECT vec_id AS conv_id, (coalesce(
         list_min(list_filter(range(0, len(p)), lambda i: list_sum(list_slice(p, 1, i + 1)) > u)),
         list_max(list_filter(range(0, len(p)), lambda i: p[i + 1] > 0))))::INTEGER AS next_id
  FROM uniform
), contexts AS (
  SELECT conv_id, turn, list_transform(string_split(right(text, {CONTEXT}), ''), lambda c: ord(c)) AS ids
  FROM conversations
)
SELECT conv_id, turn, next_id, list_append(ids, next_id) AS ids FROM contexts JOIN drawn USING (conv_id)""",
)
def generation_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.transform(characters(F.col("text")), lambda c: F.ascii(c))
    sequences = table(spark, sf_dir, "conversations").select("conv_id", "turn", ids.alias("ids"))
    logits = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("conv_id"), F.col("embedding").alias("logits")
    )
    seen = model_context(sequences, CONTEXT).join(logits, "conv_id")
    stepped = generate_step(
        seen, key="conv_id", step=3, temperature=TEMPERATURE, top_k=TOP_K, seed=SEED
    )
    return stepped.select("conv_id", "turn", "next_id", "ids")
