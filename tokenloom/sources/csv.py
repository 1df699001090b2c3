"""CSV files with a header, UTF-8 or Shift-JIS.

Files without line breaks inside quotes are divided by Spark's own reader. Those with some are
divided by `quoted_csv`, which finds out where a byte range starts inside quotes.
"""

from __future__ import annotations

import csv
import io
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.sources.files import list_files, resolve
from tokenloom.sources.quoted_csv import RANGE_BYTES, read_records

# Field texts that mean "missing".
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

_INTEGER = r"^\s*[+-]?\d{1,19}\s*$"
_DECIMAL = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"
_BOOLEAN = "^(True|False|TRUE|FALSE|true|false)$"

# Takes the field after the last one that the header names.
_EXTRA = "__extra_field"
_PATH = "__path"
_HEADER_BYTES = 1 << 16


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Sequence[str],
    delimiter: str = ",",
    schema: T.StructType | str | None = None,
    extra_fields: str = "ignore",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """The named columns, in the order of the first file, of one or more CSV files.

    Every file is read under its own header; files whose headers do not name the same
    columns are refused. A file that is not valid UTF-8 is read as Shift-JIS, dropping bytes
    it cannot decode. Missing trailing fields are null. Fields beyond the header are left out, or
    fail the job with extra_fields="fail"; `count_extra_fields` counts such rows. Types come from
    the whole data (integer, double, boolean, else text; missing values do not count) in one extra
    pass over the needed columns; give `schema` for those columns to save it. Files are split
    over tasks, those with line breaks inside quotes by `range_bytes`.
    """
    if extra_fields not in ("ignore", "fail"):
        raise ValueError("extra_fields is 'ignore' or 'fail'")
    groups = _file_groups(spark, paths, delimiter)
    header = min(groups, key=lambda g: g[1][0])[0][0]
    for (names, _, _), files in groups:
        if Counter(names) != Counter(header):
            raise ValueError(f"the header of {files[0]} has other columns: {list(names)}")
    absent = [c for c in columns if c not in header]
    if absent:
        raise ValueError(f"columns not in the CSV header: {absent}")
    wanted = [c for c in header if c in set(columns)]
    table = None
    for kind, files in groups:
        part = _read_group(spark, kind, files, delimiter, range_bytes)
        if extra_fields == "fail":
            refuse = F.raise_error(F.lit("a CSV row has more fields than its header"))
            part = part.filter(F.when(F.col(_EXTRA).isNull(), True).otherwise(refuse.cast("boolean")))
        part = part.select(*[_present(c).alias(c) for c in wanted])
        table = part if table is None else table.unionByName(part)
    types = _given_types(schema) if schema is not None else _infer_types(table)
    return table.select(*[_typed(c, types[c]).alias(c) for c in table.columns])


def count_extra_fields(spark: SparkSession, paths: str | list[str], delimiter: str = ",") -> DataFrame:
    """(path, rows): the rows of each file that have more fields than its header."""
    found = None
    for kind, files in _file_groups(spark, paths, delimiter):
        part = _read_group(spark, kind, files, delimiter, RANGE_BYTES).filter(F.col(_EXTRA).isNotNull())
        part = part.groupBy(F.col(_PATH).alias("path")).agg(F.count("*").alias("rows"))
        found = part if found is None else found.unionAll(part)
    return found


def _file_groups(
    spark: SparkSession, paths: str | list[str], delimiter: str
) -> list[tuple[tuple[tuple[str, ...], bool, bool], list[str]]]:
    """Files by (header, valid UTF-8, line breaks inside quotes), each group in path order.

    The driver holds a header per file, beside the listing that any scan of them holds.
    """
    files = [path for path, _ in list_files(spark, paths)]
    if not files:
        raise FileNotFoundError(f"no CSV file at {paths}")
    facts = _classify(spark, files)
    if not facts:
        raise ValueError(f"no rows in {paths}")
    headers = _headers(spark, sorted(facts), delimiter)
    groups: dict[tuple, list[str]] = {}
    for path in sorted(facts):
        groups.setdefault((headers[path], *facts[path]), []).append(path)
    return list(groups.items())


def _classify(spark: SparkSession, paths: list[str]) -> dict[str, tuple[bool, bool]]:
    """(valid UTF-8, has line breaks inside quotes) of every file with a line.

    Works on lines, so large files are checked in parallel; neither encoding has a
    newline byte inside a character. A line break inside quotes leaves an odd number of
    quotes on its line.
    """
    value = F.col("value")
    quotes = F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))
    facts = (
        spark.read.text(paths)
        .select(F.col("_metadata.file_path").alias("path"), value)
        .groupBy("path")
        .agg(
            F.bool_and(F.is_valid_utf8(value)).alias("utf8"),
            F.bool_or(quotes % 2 == 1).alias("multiline"),
        )
        .collect()
    )
    return {row["path"]: (row["utf8"], row["multiline"]) for row in facts}


def _headers(spark: SparkSession, paths: list[str], delimiter: str) -> dict[str, tuple[str, ...]]:
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names = [_header(path, delimiter) for path in batch["path"]]
            yield pd.DataFrame({"path": batch["path"], "names": names})

    listing = spark.createDataFrame([(p,) for p in paths], "path string")
    rows = listing.mapInPandas(read, "path string, names array<string>").collect()
    return {row["path"]: tuple(row["names"]) for row in rows}


def _header(path: str, delimiter: str) -> list[str]:
    """The first record; of equal names the later ones get .1, .2, ..."""
    filesystem, name = resolve(path)
    data, line = b"", None
    with filesystem.open_input_file(name) as file:
        while line is None:
            block = file.read(_HEADER_BYTES)
            data += block
            line = _first_record(data) if block else data
    try:
        text = line.decode("utf-8-sig")
    except UnicodeDecodeError:
        text = line.decode("shift_jis", "ignore")
    names: list[str] = []
    seen: Counter[str] = Counter()
    for field in next(csv.reader(io.StringIO(text), delimiter=delimiter), []):
        names.append(f"{field}.{seen[field]}" if seen[field] else field)
        seen[field] += 1
    return names


def _first_record(data: bytes) -> bytes | None:
    """Up to the first line end outside quotes, if it is in `data`."""
    end = data.find(b"\n")
    while end >= 0 and data[:end].count(b'"') % 2:
        end = data.find(b"\n", end + 1)
    return data[: end + 1] if end >= 0 else None


def _read_group(
    spark: SparkSession,
    kind: tuple[tuple[str, ...], bool, bool],
    files: list[str],
    delimiter: str,
    range_bytes: int,
) -> DataFrame:
    """All fields as text, under the files' header, _EXTRA and _PATH."""
    header, utf8, multiline = kind
    if not utf8 and any(0x40 <= ord(c) < 0x7F for c in delimiter):
        raise ValueError(f"{delimiter!r} may be part of a Shift-JIS character")
    names = (*header, _EXTRA)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    options = {"sep": delimiter, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}
    if multiline:
        records = read_records(spark, files, delimiter, "utf-8" if utf8 else "latin-1", range_bytes)
        # Names as positions: a header may hold any characters.
        numbered = ", ".join(f"c{i} string" for i in range(len(names)))
        fields = F.from_csv("record", numbered, {**options, "multiLine": "true"})
        parsed = records.select(F.col("path").alias(_PATH), fields.alias("r"))
        table = parsed.select(*[F.col(f"r.c{i}").alias(name) for i, name in enumerate(names)], _PATH)
    else:
        encoding = "UTF-8" if utf8 else "ISO-8859-1"
        table = spark.read.schema(schema).csv(files, header=True, encoding=encoding, **options)
        table = table.withColumn(_PATH, F.col("_metadata.file_path"))
    if utf8:
        return table
    # Spark parses bytes as characters: no byte of a Shift-JIS character is a quote, a line end
    # or one of the delimiters allowed above. Fields are decoded afterwards.
    return table.select(*[_from_shift_jis(F.col(f"`{c}`")).alias(c) for c in names], _PATH)


@F.arrow_udf(T.StringType())
def _from_shift_jis(fields: pa.Array) -> pa.Array:
    texts = [
        None if t is None else t.encode("latin-1").decode("shift_jis", "ignore")
        for t in fields.to_pylist()
    ]
    return pa.array(texts, pa.string())


def _present(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*MISSING), value)


def _infer_types(table: DataFrame) -> dict[str, T.DataType]:
    """One aggregate row over all rows decides every column."""
    facts = []
    for i, name in enumerate(table.columns):
        value = F.col(f"`{name}`")
        facts += [
            F.count(value).alias(f"n_{i}"),
            _all(value, value.rlike(_INTEGER) & value.try_cast("bigint").isNotNull(), f"i_{i}"),
            _all(value, value.rlike(_DECIMAL), f"d_{i}"),
            _all(value, value.rlike(_BOOLEAN), f"b_{i}"),
        ]
    row = table.agg(*facts).first()
    types: dict[str, T.DataType] = {}
    for i, name in enumerate(table.columns):
        if row[f"n_{i}"] == 0:
            types[name] = T.DoubleType()
        elif row[f"i_{i}"]:
            types[name] = T.LongType()
        elif row[f"d_{i}"]:
            types[name] = T.DoubleType()
        elif row[f"b_{i}"]:
            types[name] = T.BooleanType()
        else:
            types[name] = T.StringType()
    return types


def _all(value: Column, test: Column, name: str) -> Column:
    """Whether `test` holds for every value that is present."""
    return F.bool_and(F.when(value.isNotNull(), test)).alias(name)


def _given_types(schema: T.StructType | str) -> dict[str, T.DataType]:
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return {field.name: field.dataType for field in schema}


def _typed(name: str, kind: T.DataType) -> Column:
    value = F.col(f"`{name}`")
    return value if isinstance(kind, T.StringType) else F.trim(value).cast(kind)
