"""Secret scanning with an incremental ledger of content-addressed blobs.

Every version of every path is a text; its blob is the SHA-256 of its UTF-8 bytes. The ledger is
a Parquet table of (blob, rule_version, findings). A scan addresses all versions, leaves out the
(blob, rule version) pairs that the ledger holds, scans one carrier of each remaining blob where
it stands, appends to the ledger, and joins the findings back to every path with that blob.
Only narrow rows are shuffled. Carriers are told from other rows by the ids that need no scan
(broadcast while few, shuffled beyond).

Findings are the base spans of three fixed kinds, in code points, end exclusive. The method adds
no kinds of its own, so all spans are base spans.

Defined cases: a null text is the empty text; equal texts share their findings; repeated rows
each get a result row; a null path id is a path like any other; an empty table gives no rows and
adds nothing to the ledger. A lost task rescans its blobs; rows that a scan adds to the
ledger twice (two runs at once) are read as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import free_names, join_uneven, path_exists, python_tasks, small_side, stored
from tokenloom.session import shared_dir

# Fixed patterns and least lengths: kind, pattern, group whose length counts, least length.
ASSIGN = (
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
KINDS = ["assign", "access", "hex"]
RULE_VERSION = "1"
FINDINGS = "array<struct<kind:string,start:bigint,end:bigint>>"

_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
# A failing run of these two cannot hold a match that starts later in it, so the least length
# may stand in the pattern. Not so for `assign`: a failing match still uses up its text.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORDS = re.compile(r"passw|secret|token|api_?key", re.ASCII | re.IGNORECASE)


def find_secrets(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every base span, by start and then kind as listed."""
    spans = []
    if _WORDS.search(text):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return [(start, end, KINDS[kind]) for start, kind, end in sorted(spans)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    for b in batches:
        found = [
            [{"kind": k, "start": s, "end": e} for s, e, k in find_secrets(text.as_py())]
            for text in b["text"]
        ]
        yield pa.record_batch([b["blob"], pa.array(found, pa.list_(item))], ["blob", "findings"])


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def ledger(spark, folder: str, rule_version: str) -> DataFrame | None:
    """(blob, findings) of one rule version, one row per blob; None before the first scan."""
    if not path_exists(spark, folder):
        return None
    rows = spark.read.schema(f"blob string, rule_version string, findings {FINDINGS}").parquet(folder)
    return rows.filter(F.col("rule_version") == rule_version).groupBy("blob").agg(
        F.first("findings").alias("findings")
    )


def scan_versions(
    versions: DataFrame,
    folder: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    rule_version: str = RULE_VERSION,
) -> DataFrame:
    """(key, blob, findings) of every row of `versions`; new blobs are added to `folder`."""
    spark = versions.sparkSession
    python_tasks(spark)
    addressed = versions.select(F.col(key).alias("id"), blob_of(F.col(text)).alias("blob"))
    addressed = stored(addressed, "blobs")
    firsts = addressed.groupBy("blob").agg(F.min("id").alias("first"), F.count("*").alias("carriers"))
    known = ledger(spark, folder, rule_version)
    seen = F.lit(False)
    if known is not None:
        seen = F.col("known").isNotNull()
        firsts = firsts.join(known.select("blob", F.lit(True).alias("known")), "blob", "left")
    firsts = stored(firsts.select("blob", "first", "carriers", seen.alias("seen")), "first-carriers")
    # One carrier of every unseen blob is scanned. Only ids move: those to scan, or where they are most rows,
    # those to leave out.
    scan = firsts.filter("not seen").select(F.col("first").alias("own_id"), F.col("blob").alias("own_blob"))
    rows, n = addressed.count(), scan.count()
    how = "left_semi"
    if 2 * n > rows:
        others = join_uneven(addressed, firsts, "blob", "carriers", rows).filter(
            F.col("seen") | ~F.col("id").eqNullSafe(F.col("first"))
        )
        scan = stored(others.select(F.col("id").alias("own_id"), F.col("blob").alias("own_blob")).distinct(), "known-blobs")
        n, how = scan.count(), "left_anti"
    texts = versions.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        blob_of(F.col(text)).alias("blob"),
    )
    same = (F.col("blob") == F.col("own_blob")) & F.col("id").eqNullSafe(F.col("own_id"))
    unseen = texts.join(small_side(scan, n), same, how)
    (
        unseen.select("blob", "text")
        .mapInArrow(_scan, f"blob string, findings {FINDINGS}")
        .select("blob", F.lit(rule_version).alias("rule_version"), "findings")
        .write.mode("append")
        .parquet(folder)
    )
    found = ledger(spark, folder, rule_version).filter(F.size("findings") > 0)
    return addressed.join(found, "blob", "left").select(
        F.col("id").alias(key), "blob", F.coalesce("findings", F.array().cast(FINDINGS)).alias("findings")
    )


def span_text(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(
        F.transform(
            findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
        ),
        ",",
    )


def count_kind(findings: Column, kind: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["kind"] == kind)).cast("bigint")


def document_report(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    folder = folder or shared_dir(docs.sparkSession, "secret-ledger")
    found = F.col("findings")
    return scan_versions(docs, folder).select(
        "doc_id",
        *[count_kind(found, k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(found).cast("binary"), 256).alias("base_sha256"),
        span_text(found).alias("spans"),
    )


def redact(docs: DataFrame, folder: str | None = None, mark: str = "[secret]") -> DataFrame:
    """`docs` with every span replaced by `mark`; other columns and clean rows are unchanged.

    Overlapping spans are merged. n_chars, where present, is counted anew for changed texts.
    """
    folder = folder or shared_dir(docs.sparkSession, "secret-ledger")
    scan_versions(docs.select("doc_id", "text"), folder)
    blob, spans = free_names(docs, "blob", "findings")
    found = (
        ledger(docs.sparkSession, folder, RULE_VERSION)
        .filter(F.size("findings") > 0)
        .select(F.col("blob").alias(blob), F.col("findings").alias(spans))
    )
    found = stored(found, "findings")
    joined = docs.join(
        small_side(found, found.count()), blob_of(F.col("text")) == F.col(blob), "left"
    )
    cut = _cut_spans(F.col("text"), F.col(spans), mark)
    changed = F.col(spans).isNotNull()
    out = {"text": F.when(changed, cut).otherwise(F.col("text"))}
    result = joined.withColumns(out)
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        result = result.withColumn("n_chars", F.when(changed, counted).otherwise(F.col("n_chars")))
    return result.select(*docs.columns)


def _cut_spans(text: Column, findings: Column, mark: str) -> Column:
    """Replace spans, which come by start; `at` is the first code point not yet copied."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).cast("bigint").alias("at"))

    def step(acc: Column, f: Column) -> Column:
        before = F.substr(text, (acc["at"] + 1).cast("int"), (f["start"] - acc["at"]).cast("int"))
        return F.when(
            f["start"] >= acc["at"],
            F.struct(F.concat(acc["done"], before, F.lit(mark)).alias("done"), f["end"].alias("at")),
        ).otherwise(
            F.struct(acc["done"].alias("done"), F.greatest(acc["at"], f["end"]).alias("at"))
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc["done"], F.substr(text, (acc["at"] + 1).cast("int")))

    return F.aggregate(findings, start, step, finish)
