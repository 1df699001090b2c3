"""Contiguous train/validation split of a corpus by character position."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.operators.ranges import ROWS_PER_RANGE, store_ranges, sum_before

TRAIN = "train"
VAL = "val"


@dataclass(frozen=True)
class Cut:
    """Where the corpus is cut: `head` characters of document `doc_id` belong to train."""

    total: int
    position: int
    doc_id: int | None
    head: int

    @property
    def sizes(self) -> dict[str, int]:
        """Characters per split."""
        return {TRAIN: self.position, VAL: self.total - self.position}


def count_characters(corpus: DataFrame) -> DataFrame:
    """One row: the number of characters (code points) of the corpus."""
    return corpus.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0)).alias("n_chars"))


def document_offsets(corpus: DataFrame, *, length: Column | None = None) -> DataFrame:
    """(doc_id, n, start): every document's first character position in the corpus."""
    ranged = store_ranges(_lengths(corpus, length), ["doc_id"])
    return sum_before(ranged, partition=[], order=["doc_id"], value="n", out="start").drop("part")


def locate_cut(
    corpus: DataFrame,
    ratio: float = 0.9,
    *,
    length: Column | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> Cut:
    """Find the one document that the cut runs through.

    Only lengths are divided by ranges of document ids, whatever these look like: totals per range, a
    running sum over the ranges, and a second look at the single range (about `rows_per_range`
    documents) holding the cut. Nothing but the answer reaches the driver, and no text is
    shuffled. `length` may name a column already holding the number of characters, so that the
    text is not read here.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must lie between 0 and 1")
    ranged = store_ranges(_lengths(corpus, length), ["doc_id"], rows_per_range=rows_per_range)
    totals = ranged.groupBy("part").agg(F.sum("n").alias("n"))
    total = totals.agg(F.sum("n")).first()[0] or 0
    position = int(total * float(ratio))
    if position >= total:
        return Cut(total, position, None, 0)
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    part, before = _holding(totals.withColumn("start", F.sum("n").over(along)), position, "part")
    window = Window.orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.filter(F.col("part") == part).withColumn("start", F.sum("n").over(window))
    doc_id, head = _holding(inside, position - before, "doc_id")
    return Cut(total, position, doc_id, position - before - head)


def _holding(rows: DataFrame, position: int, name: str) -> tuple:
    """(name, start) of the row whose characters hold `position`."""
    start = F.coalesce("start", F.lit(0).cast("bigint"))
    return rows.filter((start <= position) & (start + F.col("n") > position)).select(name, start).first()


def split_corpus(corpus: DataFrame, ratio: float = 0.9, *, cut: Cut | None = None) -> DataFrame:
    """(split, doc_id, text): the first `int(n * ratio)` characters are train, the rest val.

    Map-only: documents before and after the cut are tagged by comparing their id, and
    only the straddling one is cut in two. Empty pieces are dropped.
    """
    cut = cut or locate_cut(corpus, ratio)
    text = F.col("text")
    if cut.doc_id is None:
        return corpus.filter(text != "").select(F.lit(TRAIN).alias("split"), "doc_id", "text")
    doc = F.col("doc_id")
    head = F.substring("text", 1, cut.head)
    tail = F.substring(text, F.lit(cut.head + 1), F.char_length(text))
    pieces = (
        F.when(doc < cut.doc_id, F.array(_piece(TRAIN, text)))
        .when(doc > cut.doc_id, F.array(_piece(VAL, text)))
        .otherwise(F.array(_piece(TRAIN, head), _piece(VAL, tail)))
    )
    return (
        corpus.select("doc_id", F.explode(pieces).alias("piece"))
        .select("piece.split", "doc_id", "piece.text")
        .filter(F.col("text") != "")
    )


def one_split(corpus: DataFrame, name: str, ratio: float = 0.9, *, cut: Cut | None = None) -> DataFrame:
    """The rows of one split only; the id range reaches the scan as a pushed filter."""
    cut = cut or locate_cut(corpus, ratio)
    if cut.doc_id is not None:
        side = F.col("doc_id") <= cut.doc_id if name == TRAIN else F.col("doc_id") >= cut.doc_id
        corpus = corpus.filter(side)
    return split_corpus(corpus, cut=cut).filter(F.col("split") == name)


def _piece(split: str, text: Column) -> Column:
    return F.struct(F.lit(split).alias("split"), text.alias("text"))


def _lengths(corpus: DataFrame, length: Column | None) -> DataFrame:
    n = F.char_length("text") if length is None else length
    return corpus.select("doc_id", F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))
