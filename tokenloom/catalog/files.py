"""Queries through files: CSV, Parquet globs, zip archives, token files, vocabularies.

Every file is written by Spark from the given tables, in a new shared folder.
"""

from __future__ import annotations

import uuid
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.catalog.corpus import (
    BLOCK_SIZE,
    CHUNKS_SQL,
    VOCAB_SQL,
    char_chunks,
    documents,
)
from tokenloom.catalog.registry import query, table
from tokenloom.operators.ranges import store_ranges, sum_before
from tokenloom.operators.vocab import build_vocab
from tokenloom.plans.prepare import prepare_corpus
from tokenloom.session import shared_dir
from tokenloom.sinks.files import export_text, save_csv, save_parquet
from tokenloom.sinks.tokens import write_chunks, write_token_files, write_vocab
from tokenloom.sources.archives import list_members, read_extracted, read_members, unzip_files
from tokenloom.sources.csv import read_csv
from tokenloom.sources.files import join, publish, resolve
from tokenloom.sources.parquet import read_each_parquet, read_parquets
from tokenloom.sources.tables import read_chunks, read_vocab
from tokenloom.sources.text import read_text
from tokenloom.sources.token_files import read_token_dataset

DOCS_PER_ARCHIVE = 32

CUSTOMER_SQL = """
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer"""


@query("csv_roundtrip", CUSTOMER_SQL)
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = save_csv(customer, shared_dir(spark, "csv"), "customer", timestamp=True)
    return read_csv(spark, path, customer.columns)


@query("csv_projection", "SELECT c_name, c_acctbal FROM customer")
def csv_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = save_csv(customer, shared_dir(spark, "csv"), "customer", timestamp=False)
    return read_csv(spark, path, ["c_acctbal", "c_name"])


@query("csv_quoted_text", "SELECT doc_id, text FROM documents")
def csv_quoted_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = save_csv(documents(spark, sf_dir), shared_dir(spark, "csv"), "documents", timestamp=False)
    return read_csv(spark, path, ["doc_id", "text"])


@query(
    "csv_mixed_headers",
    "SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal FROM customer",
)
def csv_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files whose headers name the same columns in different orders."""
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal"]
    customer = table(spark, sf_dir, "customer").select(*columns)
    folder = shared_dir(spark, "csv")
    even = F.col("c_custkey") % 2 == 0
    paths = [
        save_csv(customer.filter(even), folder, "even", timestamp=False),
        save_csv(customer.filter(~even).select(*columns[::-1]), folder, "odd", timestamp=False),
    ]
    return read_csv(spark, [join(p, "*.csv") for p in paths], columns)


# Characters that Shift-JIS has and that are not valid UTF-8 when written in it.
JAPANESE_SQL = """
SELECT c_custkey, '顧客' || c_name AS name, {note} AS note, c_acctbal FROM customer"""


@F.arrow_udf(T.StringType())
def shift_jis_bytes(texts: pa.Array) -> pa.Array:
    """A character for each byte of the text in Shift-JIS."""
    return pa.array([t.encode("shift_jis").decode("latin-1") for t in texts.to_pylist()], pa.string())


def japanese_customers(spark: SparkSession, sf_dir: str, note: Column) -> DataFrame:
    """Customers written to Shift-JIS files and read back."""
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey",
        shift_jis_bytes(F.concat(F.lit("顧客"), "c_name")).alias("name"),
        shift_jis_bytes(note).alias("note"),
        "c_acctbal",
    )
    path = shared_dir(spark, "shift-jis")
    customer.write.options(header=True, quoteAll=True, escape='"', encoding="ISO-8859-1").csv(path)
    return read_csv(spark, join(path, "*.csv"), ["c_custkey", "name", "note", "c_acctbal"])


@query("csv_shift_jis", JAPANESE_SQL.format(note="c_mktsegment || '表'"))
def csv_shift_jis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return japanese_customers(spark, sf_dir, F.concat("c_mktsegment", F.lit("表")))


@query("csv_shift_jis_quoted", JAPANESE_SQL.format(note="c_mktsegment || chr(10) || '\"表\"'"))
def csv_shift_jis_quoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With line breaks and quotes inside the fields."""
    return japanese_customers(spark, sf_dir, F.concat("c_mktsegment", F.lit('\n"表"')))


@query(
    "parquet_glob",
    """
SELECT 'nation' AS source, n_nationkey AS key, n_name AS name FROM nation
UNION ALL SELECT 'region', r_regionkey, r_name FROM region
UNION ALL SELECT 'customer', c_custkey, c_name FROM customer""",
)
def parquet_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "parquet")
    for name, prefix in (("nation", "n_nation"), ("region", "r_region"), ("customer", "c_cust")):
        part = table(spark, sf_dir, name)
        part = part.select(
            F.col(f"{prefix}key").cast("bigint").alias("key"), F.col(f"{prefix[:2]}name").alias("name")
        )
        save_parquet(part, folder, f"{name}.parquet", timestamp=False)
    rows = read_parquets(spark, join(folder, "*.parquet", "*.parquet"))
    source = F.regexp_extract("file_path", r"/(\w+)\.parquet/[^/]*$", 1)
    return rows.select(source.alias("source"), "key", "name")


@query("parquet_each", "SELECT c_custkey, c_name FROM customer")
def parquet_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two frames of single files and one scan of the rest."""
    folder = shared_dir(spark, "parquet")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    path = save_parquet(customer.repartition(5, "c_custkey"), folder, "customer", timestamp=False)
    files = read_each_parquet(spark, join(path, "*.parquet"))
    return files[0].unionAll(files[1]).unionAll(files[2:].rows().drop("file_path"))


def write_archives(docs: DataFrame, folder: str) -> str:
    """One zip per DOCS_PER_ARCHIVE consecutive documents, written by the tasks."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        filesystem, root = resolve(folder)
        filesystem.create_dir(root, recursive=True)
        number = int(rows["archive"].iloc[0])
        final = join(root, f"docs-{number:08d}.zip")
        temporary = f"{final}.{uuid.uuid4().hex}"
        with filesystem.open_output_stream(temporary) as out:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for doc_id, text in zip(rows["doc_id"], rows["text"]):
                    archive.writestr(f"d{doc_id % 3}/{doc_id}.txt", text)
        publish(filesystem, temporary, final)
        return pd.DataFrame({"archive": [number]})

    numbered = docs.withColumn("archive", F.expr(f"doc_id div {DOCS_PER_ARCHIVE}"))
    packed = numbered.groupBy("archive").applyInPandas(pack, "archive bigint")
    packed.write.format("noop").mode("overwrite").save()
    return join(folder, "*.zip")


MEMBERS_SQL = f"""
SELECT doc_id // {DOCS_PER_ARCHIVE} AS archive, 'd' || (doc_id % 3) || '/' || doc_id || '.txt' AS member,
       strlen(text)::BIGINT AS n_bytes"""

def archive_number() -> Column:
    return F.regexp_extract("zip_path", r"docs-(\d+)\.zip$", 1).cast("bigint").alias("archive")


@query("zip_members", MEMBERS_SQL + ", text FROM documents")
def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    glob = write_archives(documents(spark, sf_dir), shared_dir(spark, "zip"))
    listed = list_members(spark, glob).select("zip_path", "ordinal", "n_bytes")
    parts = F.array_sort(F.collect_list(F.struct("part", "content")))
    whole = read_members(spark, glob).groupBy("zip_path", "ordinal", "member").agg(
        parts.alias("parts")
    )
    text = F.array_join(F.transform("parts", lambda p: F.decode(p["content"], "UTF-8")), "")
    return whole.join(listed, ["zip_path", "ordinal"]).select(
        archive_number(), "member", "n_bytes", text.alias("text")
    )


@query("zip_extract", MEMBERS_SQL + ", md5(text) AS text_md5 FROM documents")
def zip_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    glob = write_archives(documents(spark, sf_dir), shared_dir(spark, "zip"))
    target = shared_dir(spark, "extracted")
    files = read_extracted(unzip_files(spark, glob, target), target)
    return files.select(archive_number(), "member", "n_bytes", F.md5("content").alias("text_md5"))


@query(
    "token_file_roundtrip",
    CHUNKS_SQL + "SELECT split, chunk_id::BIGINT AS chunk_id, tokens FROM chunks",
)
def token_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = write_chunks(char_chunks(spark, sf_dir), shared_dir(spark, "chunks"))
    folder = write_token_files(
        read_chunks(spark, stored), shared_dir(spark, "tokens"), chunk_size=BLOCK_SIZE, ordered=True
    )
    return read_token_dataset(spark, folder, chunk_size=BLOCK_SIZE)


@query(
    "token_shards",
    CHUNKS_SQL
    + "SELECT split, chunk_id::BIGINT AS chunk_id, tokens FROM chunks WHERE split = 'train'",
)
def token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = write_chunks(char_chunks(spark, sf_dir), shared_dir(spark, "chunks"))
    return read_chunks(spark, stored, split="train")


@query(
    "prepared_corpus",
    CHUNKS_SQL + "SELECT split, chunk_id::BIGINT AS chunk_id, tokens FROM chunks",
)
def prepared_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    corpus = table(spark, sf_dir, "documents").select("doc_id", "text")
    data = prepare_corpus(corpus, shared_dir(spark, "prepared"), chunk_size=BLOCK_SIZE)
    return read_chunks(spark, data.chunks)


@query("vocab_roundtrip", VOCAB_SQL.replace(",", "WITH", 1) + "SELECT id, ch FROM vocab")
def vocab_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "vocab")
    missing = read_vocab(spark, path)
    write_vocab(build_vocab(documents(spark, sf_dir)), path)
    return missing.unionAll(read_vocab(spark, path))


def save_once(df: DataFrame, label: str) -> DataFrame:
    """`df` written to a shared folder and read back, where several passes follow."""
    folder = shared_dir(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@query(
    "text_roundtrip",
    """
SELECT row_number() OVER (ORDER BY doc_id, i) - 1 AS line_no, line FROM (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
)
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of the written corpus in its place, blank ones included."""
    path = export_text(documents(spark, sf_dir), shared_dir(spark, "text"))
    corpus = read_text(spark, join(path, "*.txt"), range_bytes=1 << 18, piece_bytes=1 << 14)
    lines = F.split("text", "\n")
    pieces = save_once(corpus.withColumn("breaks", (F.size(lines) - 1).cast("bigint")), "pieces")
    placed = sum_before(
        store_ranges(pieces.select("doc_id", "breaks"), ["doc_id"]),
        partition=[], order=["doc_id"], value="breaks", out="before",
    )
    starts = placed.select("doc_id", "before")
    numbered = pieces.join(starts, "doc_id").select(
        "doc_id", "breaks", "before", F.posexplode(lines).alias("at", "line")
    ).withColumn("line_no", F.col("before") + F.col("at"))
    # A line that a piece or a file ends in goes on in the next one; all others are in one piece.
    inside = (F.col("at") > 0) & (F.col("at") < F.col("breaks"))
    parts = F.array_sort(F.collect_list(F.struct("doc_id", "line")))
    ends = numbered.filter(~inside).groupBy("line_no").agg(F.array_join(parts["line"], "").alias("line"))
    total = pieces.agg(F.sum("breaks")).first()[0]
    whole = numbered.filter(inside).select("line_no", "line").unionAll(ends)
    return whole.filter(F.col("line_no") < total)
