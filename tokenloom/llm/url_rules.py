"""URL allow and block rules by a sort-merge range join.

A host is keyed by its labels in reverse, each followed by a dot (`www.example.com` becomes
`com.example.www.`). The hosts a rule covers, its own and all subdomains, are then exactly the
keys that begin with the rule's key: one interval of the sorted order. URLs and rules are cut
into the same ranges of that order; a rule is copied to each range that its interval meets. Every
range is sorted (by Spark, on disk if need be) and swept once: a stack holds the rules whose
interval is open, a rule's paths are looked up by prefix length. Many URLs of one host are
divided over ranges by a hash of the URL.

Defined cases: a null URL or one without `://` has empty host and path and fits no rule, as does
any host outside all intervals; such URLs get `default`. Rules with a null host, path or verdict
are ignored. The longest rule (host and path) wins, then the one with the longer host; among
equal rules with different verdicts `block` wins. Repeated URLs are each judged; an empty table
gives no rows, an empty rule table the default.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import cut_points, part_of, parts_for, python_tasks

# Fixed rules of the registered query: host, path, verdict.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
RULE_SCHEMA = "host string, path string, verdict string"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS_PER_PART = 200_000


def url_host(url: Column) -> Column:
    """Between the first `://` and the next `/`, `?`, `#` or the end; A-Z lower-cased."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host_key(host: Column) -> Column:
    labels = F.reverse(F.split(host, r"\."))
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(labels, "."), F.lit(".")))


_FIELDS = ["part", "key", "kind", "row", "host", "path", "verdict"]
_DEALT = "part int, key string, kind int, row bigint, host string, path string, verdict string"


def _pages_in_parts(cuts: list[tuple]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keyed = zip(b["key"].to_pylist(), b["salt"].to_pylist())
            parts = pa.array([part_of(cuts, k, s) for k, s in keyed], pa.int32())
            yield pa.record_batch([parts, *[b[f] for f in _FIELDS[1:]]], _FIELDS)

    return run


def _rules_in_parts(cuts: list[tuple]):
    lowest, highest = -(1 << 63) - 1, 1 << 63

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, rows = [], []
            for i, key in enumerate(b["key"].to_pylist()):
                # A key ends in "."; "/" is the next character, so it closes the interval.
                last = part_of(cuts, key[:-1] + "/", highest)
                for part in range(part_of(cuts, key, lowest), last + 1):
                    parts.append(part)
                    rows.append(i)
            copies = b.take(pa.array(rows, pa.int64()))
            columns = [pa.array(parts, pa.int32()), *[copies[f] for f in _FIELDS[1:]]]
            yield pa.record_batch(columns, _FIELDS)

    return run


class _Open:
    """The rules of one host whose interval holds the current key."""

    def __init__(self, key: str, host: str):
        self.key, self.host = key, host
        self.paths: dict[str, str] = {}
        self.lengths: list[int] = []

    def add(self, path: str, verdict: str) -> None:
        if path not in self.paths and len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)
        if self.paths.get(path) != "block":
            self.paths[path] = verdict

    def longest(self, path: str) -> str | None:
        for n in self.lengths:
            if n <= len(path) and path[:n] in self.paths:
                return path[:n]
        return None


def _sweep(default: str):
    schema = pa.schema(
        [("row", pa.int64()), *[(f, pa.string()) for f in ("host", "path", "rule", "verdict")]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        current = None
        for b in batches:
            out: list[tuple] = []
            for part, key, kind, row, host, path, verdict in zip(*[b[f].to_pylist() for f in _FIELDS]):
                if part != current:
                    stack, current = [], part
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind == 0:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key, host))
                    stack[-1].add(path, verdict)
                    continue
                best = None
                for entry in stack:
                    found = entry.longest(path)
                    if found is not None:
                        size = (len(entry.host) + len(found), len(entry.host))
                        if best is None or size > best[0]:
                            best = (size, entry.host + found, entry.paths[found])
                rule, says = (best[1], best[2]) if best else (None, default)
                out.append((row, host, path, rule, says))
            columns = zip(*out) if out else [[]] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_column: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every row of `pages`.

    `rules` has host, path and verdict. `id_column` is a 64-bit integer.
    """
    spark = pages.sparkSession
    python_tasks(spark)
    parsed = pages.select(
        F.col(id_column).cast("bigint").alias("row"),
        url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"),
        F.xxhash64(F.col(url), F.col(id_column)).alias("salt"),
    ).withColumns({"key": host_key(F.col("host")), "kind": F.lit(1), "verdict": F.lit(None).cast("string")})
    rows = parsed.count()
    parts = parts_for(spark, rows, ROWS_PER_PART)
    cuts = cut_points(parsed, "key", parts, rows)
    ruled = (
        rules.select("host", "path", "verdict")
        .dropna()
        .filter("host <> ''")
        .withColumn("host", F.translate("host", UPPER, LOWER))
        .withColumns({"key": host_key(F.col("host")), "kind": F.lit(0), "row": F.lit(None).cast("bigint")})
    )
    dealt = parsed.mapInArrow(_pages_in_parts(cuts), _DEALT).unionByName(
        ruled.mapInArrow(_rules_in_parts(cuts), _DEALT)
    )
    swept = (
        dealt.repartition(parts, "part")
        .sortWithinPartitions("part", "key", "kind")
        .mapInArrow(_sweep(default), "row bigint, host string, path string, rule string, verdict string")
    )
    return swept.select(F.col("row").alias(id_column), "host", "path", "rule", "verdict")
