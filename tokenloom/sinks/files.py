"""Text, Parquet and CSV output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.sinks.paths import output_path


def export_text(corpus: DataFrame, path: str) -> str:
    """Write the bare text, in `doc_id` order over the sorted file names."""
    corpus.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("text").write.option(
        "lineSep", "\n"
    ).text(path)
    return path


def save_parquet(df: DataFrame, folder: str, name: str, timestamp: bool = True) -> str:
    path = output_path(folder, name, timestamp)
    df.write.parquet(path)
    return path


def save_csv(df: DataFrame, folder: str, name: str, timestamp: bool = True) -> str:
    """CSV with header, every field quoted, quotes doubled, null as an empty field."""
    path = output_path(folder, name, timestamp)
    as_text = df.select(*[_csv_text(df, f).alias(f.name) for f in df.schema])
    as_text.write.options(
        header=True, quoteAll=True, escape='"', nullValue="", emptyValue=""
    ).csv(path)
    return path


def _csv_text(df: DataFrame, field: T.StructField) -> Column:
    value = df[f"`{field.name}`"]
    if isinstance(field.dataType, T.BooleanType):
        return F.when(value, "True").when(~value, "False")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return _number_text(value)
    return value.cast("string")


def _number_text(value: Column) -> Column:
    """Shortest text of a floating number: plain from 1e-4 up to 1e16, else with a
    two-digit exponent; NaN is an empty field."""
    text = value.cast("string")
    parts = r"^(-?)(\d)\.(\d+)E(-?)(\d+)$"
    sign, first, rest = (F.regexp_extract(text, parts, i) for i in (1, 2, 3))
    rest = F.when(rest == "0", "").otherwise(rest)
    negative = F.regexp_extract(text, parts, 4) == "-"
    exponent = F.regexp_extract(text, parts, 5).try_cast("int")
    whole = F.concat(sign, first, F.rpad(rest, exponent, "0"), F.lit(".0"))
    mixed = F.concat(
        sign, first, F.substring(rest, F.lit(1), exponent), F.lit("."),
        F.substring(rest, exponent + 1, F.length(rest)),
    )
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), exponent - 1), first, rest)
    scientific = F.concat(
        sign, first, F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"),
        F.when(negative, "-").otherwise("+"), F.lpad(exponent.cast("string"), F.greatest(
            F.lit(2), F.length(exponent.cast("string"))), "0"),
    )
    return (
        F.when(F.isnan(value), None)
        .when(text == "Infinity", "inf")
        .when(text == "-Infinity", "-inf")
        .when(~text.contains("E"), text)
        .when(~negative & (exponent < 16) & (F.length(rest) <= exponent), whole)
        .when(~negative & (exponent < 16), mixed)
        .when(negative & (exponent <= 4), small)
        .otherwise(scientific)
    )
