"""Table schemas shared by readers, operators and tests."""

from pyspark.sql import types as T

CORPUS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)

SPLIT_TEXT = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
    ]
)

TOKEN_CHUNKS = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("chunk_id", T.LongType()),
        T.StructField("tokens", T.ArrayType(T.IntegerType())),
    ]
)

VOCAB = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("ch", T.StringType())])

BPE_RANKS = T.StructType(
    [T.StructField("token", T.BinaryType()), T.StructField("rank", T.IntegerType())]
)

LOGITS = T.StructType(
    [
        T.StructField("split", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("logits", T.ArrayType(T.FloatType())),
        T.StructField("target", T.IntegerType()),
    ]
)

EVAL_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("iter", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("train_loss", T.DoubleType()),
        T.StructField("val_loss", T.DoubleType()),
        T.StructField("lr", T.DoubleType()),
        T.StructField("mfu", T.DoubleType()),
    ]
)

STEP_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("iter", T.LongType()),
        T.StructField("microstep", T.IntegerType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("loss", T.DoubleType()),
    ]
)

CHECKPOINTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("iter", T.LongType()),
        T.StructField("best_val_loss", T.DoubleType()),
        T.StructField("path", T.StringType()),
    ]
)

# What the run report needs of a run's configuration.
RUN_CONFIG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("batch_size", T.IntegerType()),
        T.StructField("block_size", T.IntegerType()),
        T.StructField("vocab_size", T.IntegerType()),
        T.StructField("n_layers", T.IntegerType()),
        T.StructField("n_head", T.IntegerType()),
        T.StructField("n_embed", T.IntegerType()),
        T.StructField("bias", T.BooleanType()),
        T.StructField("learning_rate", T.DoubleType()),
        T.StructField("min_lr", T.DoubleType()),
        T.StructField("warmup_iters", T.IntegerType()),
        T.StructField("lr_decay_iters", T.IntegerType()),
        T.StructField("gradient_accumulation_steps", T.IntegerType()),
    ]
)
