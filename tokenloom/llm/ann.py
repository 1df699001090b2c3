"""Approximate nearest neighbours by multiprobe p-stable hashing.

The largest inner product is turned into the smallest Euclidean distance: vectors are divided by
the largest norm M and get one more component, sqrt(1 - |v|^2) for candidates and 0 for
queries. A table hashes a vector with `functions` projections onto Gaussian directions,
floor((a.v + b) / WIDTH) each. A query visits its own bucket and the perturbed ones (one cell down
or up in some functions) in the order of their estimated success: its distances to the cell
borders are ranked, and the sets of ranks come in the order of their expected score, a list that is the
same for all queries. Candidates of all tables are merged and ranked by exact inner products of
the original vectors in double precision.

Buckets of all tables are dealt to parts of about PART_BYTES of vectors, and a part is divided
into pieces of that size where a bucket is larger, so nothing is capped. A query goes once to every
piece with buckets it visits; there it is compared with their vectors in blocks, and at most k
results a piece leave it. Single precision only chooses, with room for its error, whose scores are
computed.

The more rows, the more functions (at most the logarithm of the rows), so buckets keep their size, as
long as PROBES buckets hold the neighbours. That is measured on the vectors at hand: the true
neighbours of SAMPLED queries are found by comparing them with all vectors, and the operator takes
the most functions with which PROBES buckets a table hold the share TARGET of them. Without
functions all vectors are one bucket and results are exact, so there is always such a number. On
vectors without any structure, like the given tables, neighbours are hardly nearer than other
vectors, so functions stay few and a query meets a large share of all vectors: the cost then grows
with rows times queries. Recall is measured in tests/llm.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows with a null vec_id; a query never finds its own
vec_id; equal scores go to the smaller vec_id, and equal vectors have equal scores; repeated vec_ids
count once, with their best score; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.llm.common import python_tasks, stored

TABLES = 2
PROBES = 600
WIDTH = 2.5
# Queries whose true neighbours decide the number of functions, and the share that must be held. It
# is above the 0.9 that all queries need, for the error of the sample.
SAMPLED = 64
TARGET = 0.95
SEED = 20
PART_BYTES = 1 << 25
QUERY_BLOCK = 64


def functions_for(rows: int) -> int:
    """The most functions for so many rows."""
    return max(2, math.floor(math.log2(max(rows, 2))) - 6)


@lru_cache(maxsize=4)
def probing_sequence(functions: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of border ranks (0-based, nearest first) in the order of their expected score.

    Rank r and rank 2m-1-r are the two borders of one function, so no set holds both.
    """
    m = functions
    cost = [
        j * (j + 1) / (4 * (m + 1) * (m + 2))
        if j <= m
        else 1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2))
        for j in range(1, 2 * m + 1)
    ]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))] if m else []
    while heap and len(found) < probes:
        score, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            if len(ranks) < m:
                heapq.heappush(heap, (score + cost[last + 1], (*ranks, last + 1)))
    return found


@lru_cache(maxsize=4)
def directions(dimension: int, functions: int) -> tuple[np.ndarray, np.ndarray]:
    """(tables x dimension x functions, offsets), the same in every task."""
    rng = np.random.default_rng(SEED)
    a = rng.standard_normal((TABLES, dimension, functions))
    if functions <= dimension:
        a = np.stack([np.linalg.qr(x)[0] * math.sqrt(dimension) for x in a])
    return a, rng.uniform(0, WIDTH, (TABLES, functions))


def bucket_ids(cells: np.ndarray, table: int) -> np.ndarray:
    """A 64-bit number for each row of cell numbers; two buckets that share one are one bucket."""
    h = np.full(cells.shape[0], table + 1, dtype=np.uint64)
    for j in range(cells.shape[1]):
        h = (h ^ cells[:, j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), dimension)


def _candidates(x: np.ndarray, norm: float) -> np.ndarray:
    x = x / norm
    return np.hstack([x, np.sqrt(np.maximum(0.0, 1.0 - (x * x).sum(axis=1)))[:, None]])


def _queries(x: np.ndarray, norm: float) -> np.ndarray:
    return np.hstack([x / norm, np.zeros((len(x), 1))])


def own_buckets(x: np.ndarray, a: np.ndarray, offsets: np.ndarray, table: int) -> np.ndarray:
    return bucket_ids(np.floor((x @ a + offsets) / WIDTH), table)


def visited_buckets(x: np.ndarray, functions: int) -> np.ndarray:
    """The buckets that each query visits, those of all tables in one row."""
    a, offsets = directions(x.shape[1], functions)
    sequence = probing_sequence(functions, PROBES)
    visited = []
    for t in range(TABLES):
        place = (x @ a[t] + offsets[t]) / WIDTH
        cells = np.floor(place)
        down = place - cells
        ranked = np.argsort(np.hstack([down, 1.0 - down]), axis=1, kind="stable")
        for ranks in sequence:
            moved = cells.copy()
            for r in ranks:
                border = ranked[:, r]
                moved[np.arange(len(x)), border % functions] += np.where(border < functions, -1, 1)
            visited.append(bucket_ids(moved, t))
    return np.stack(visited, axis=1)


def _index(dimension: int, functions: int, norm: float):
    """Rows (bucket, vec_id, vector) of every table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, offsets = directions(dimension + 1, functions)
        for b in batches:
            x = _candidates(_matrix(b["vector"], dimension), norm)
            for t in range(TABLES):
                ids = pa.array(own_buckets(x, a[t], offsets[t], t))
                yield pa.record_batch([ids, b["vec_id"], b["vector"]], ["bucket", "vec_id", "vector"])

    return run


def _probe(dimension: int, functions: int, norm: float, parts: int):
    """Rows (part, buckets, vec_id, vector): the buckets that a query visits, by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _queries(_matrix(b["vector"], dimension), norm)
            yield from _by_part(b, visited_buckets(x, functions), parts)

    return run


def _by_part(b: pa.RecordBatch, visited: np.ndarray, parts: int) -> Iterator[pa.RecordBatch]:
    part = np.mod(visited, parts)
    row = np.repeat(np.arange(len(b)), visited.shape[1])
    order = np.lexsort((part.ravel(), row))
    row, flat_part, flat = row[order], part.ravel()[order], visited.ravel()[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (flat_part[1:] != flat_part[:-1])
    starts = np.append(np.flatnonzero(new), len(row))
    buckets = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat))
    taken = b.take(pa.array(row[starts[:-1]]))
    yield pa.record_batch(
        [pa.array(flat_part[starts[:-1]], pa.int64()), buckets, taken["vec_id"], taken["vector"]],
        ["part", "buckets", "vec_id", "vector"],
    )


class _Piece:
    """The vectors of one piece, by bucket."""

    def __init__(self):
        self.buckets: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []

    def add(self, bucket: int, vec_id: np.ndarray, rows: np.ndarray) -> None:
        self.buckets.append(bucket)
        self.ids.append(vec_id)
        self.rows.append(rows)

    def close(self) -> _Piece:
        self.bucket, self.id = np.concatenate(self.buckets), np.concatenate(self.ids)
        order = np.lexsort((self.id, self.bucket))
        self.bucket, self.id = self.bucket[order], self.id[order]
        self.x = np.concatenate(self.rows)[order]
        self.names, self.starts = np.unique(self.bucket, return_index=True)
        self.number = np.searchsorted(self.names, self.bucket)
        self.single = self.x.astype(np.float32)
        self.norm = float(np.sqrt((self.x * self.x).sum(axis=1).max()))
        return self


def _best(piece: _Piece, ids: np.ndarray, x: np.ndarray, visited: list[np.ndarray], k: int):
    """The k nearest of each query among the vectors in the buckets it visits here."""
    open_ = np.zeros((len(ids), len(piece.names)), dtype=bool)
    for i, buckets in enumerate(visited):
        at = np.minimum(np.searchsorted(piece.names, buckets), len(piece.names) - 1)
        open_[i, at[piece.names[at] == buckets]] = True
    scores = x.astype(np.float32) @ piece.single.T
    scores[~open_[:, piece.number] | (piece.id[None, :] == ids[:, None])] = -np.inf
    out = []
    for i in range(len(ids)):
        slack = 1.2e-7 * x.shape[1] * np.sqrt((x[i] * x[i]).sum()) * piece.norm
        found = _distinct(piece, x[i], _largest(scores[i], k * TABLES, slack), k)
        if len(found[0]) < k:
            found = _distinct(piece, x[i], np.flatnonzero(scores[i] > -np.inf), k)
        out.append(found)
    return out


def _largest(scores: np.ndarray, n: int, slack: float) -> np.ndarray:
    """Places of the n largest scores and of those that may be as large."""
    if len(scores) <= n:
        return np.flatnonzero(scores > -np.inf)
    edge = np.partition(scores, len(scores) - n)[len(scores) - n]
    return np.flatnonzero((scores >= edge - slack) & (scores > -np.inf))


def _distinct(piece: _Piece, query: np.ndarray, near: np.ndarray, k: int):
    """The k best (vec_id, exact score) of these places, each vec_id once."""
    # One order of summation for all, so equal vectors have equal scores.
    exact = (piece.x[near] * query).sum(axis=1)
    order = np.lexsort((piece.id[near], -exact))
    ids = piece.id[near][order]
    first = np.sort(np.unique(ids, return_index=True)[1])[:k]
    return ids[first], exact[order][first]


def _compare(dimension: int, k: int):
    """Over rows sorted by piece, vectors before queries."""
    names = ["query_id", "vec_id", "score"]

    def answers(piece: _Piece, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, x = np.asarray(rows["vec_id"]), _matrix(rows["vector"], dimension)
        lists = [v.values.to_numpy() for v in rows["buckets"]]
        for at in range(0, len(ids), QUERY_BLOCK):
            cut = slice(at, at + QUERY_BLOCK)
            found = _best(piece, ids[cut], x[cut], lists[cut], k)
            counts = [len(f[0]) for f in found]
            yield pa.record_batch(
                [
                    pa.array(np.repeat(ids[cut], counts), pa.int64()),
                    pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.float64()),
                ],
                names,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, piece, closed = None, None, None
        for b in batches:
            keys = np.stack([np.asarray(b["part"]), np.asarray(b["piece"]), np.asarray(b["kind"])], axis=1)
            new = np.ones(len(b), dtype=bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            edges = np.append(np.flatnonzero(new), len(b))
            for a, z in zip(edges[:-1], edges[1:]):
                rows, key = b.slice(a, z - a), (keys[a, 0], keys[a, 1])
                if key != current:
                    current, piece, closed = key, None, None
                if keys[a, 2] == 0:
                    piece = piece or _Piece()
                    bucket = np.asarray(rows["buckets"].flatten())
                    piece.add(bucket, np.asarray(rows["vec_id"]), _matrix(rows["vector"], dimension))
                elif piece is not None:
                    closed = closed or piece.close()
                    yield from answers(closed, rows)

    return run


def _true_neighbours(dimension: int, k: int, ids: np.ndarray, x: np.ndarray):
    """One row (queries, vec_ids, scores) of every task: the k best of its vectors for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        everywhere = [np.zeros(1, dtype=np.int64)] * len(ids)
        held = [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(ids)
        for b in batches:
            if not len(b):
                continue
            piece = _Piece()
            piece.add(np.zeros(len(b), dtype=np.int64), np.asarray(b["vec_id"]), _matrix(b["vector"], dimension))
            found = _best(piece.close(), ids, x, everywhere, k)
            held = [_merged([h, f], k) for h, f in zip(held, found)]
        yield pa.record_batch(
            [
                pa.array([np.repeat(np.arange(len(ids)), [len(h[0]) for h in held])], pa.list_(pa.int64())),
                pa.array([np.concatenate([h[0] for h in held])], pa.list_(pa.int64())),
                pa.array([np.concatenate([h[1] for h in held])], pa.list_(pa.float64())),
            ],
            ["queries", "vec_ids", "scores"],
        )

    return run


def _merged(found: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (vec_id, score) of several results, each vec_id once."""
    ids, scores = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((ids, -scores))
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:k]
    return ids[order][first], scores[order][first]


def share_held(queries: np.ndarray, neighbours: np.ndarray, of: np.ndarray, functions: int) -> float:
    """The share of neighbours that stand in a bucket their query visits; neighbour i is one of query of[i]."""
    a, offsets = directions(queries.shape[1], functions)
    visited = visited_buckets(queries, functions)
    held = np.zeros(len(of), dtype=bool)
    for t in range(TABLES):
        own = own_buckets(neighbours, a[t], offsets[t], t)
        held |= np.array([own[i] in visited[q] for i, q in enumerate(of)], dtype=bool)
    return float(held.mean())


def chosen_functions(given: DataFrame, asked: DataFrame, dimension: int, rows: int, norm: float, k: int) -> int:
    """The most functions with which the buckets visited hold TARGET of the sampled queries' neighbours."""
    most = functions_for(rows)
    sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLED).collect()
    if not sample:
        return most
    ids = np.array([r["vec_id"] for r in sample], dtype=np.int64)
    x = np.array([r["vector"] for r in sample], dtype=np.float64)
    found = given.mapInArrow(
        _true_neighbours(dimension, k, ids, x), "queries array<bigint>, vec_ids array<bigint>, scores array<double>"
    ).toArrow()
    q, v, score = (found[c].combine_chunks().flatten().to_numpy() for c in ("queries", "vec_ids", "scores"))
    near = [_merged([(v[q == i], score[q == i])], k)[0] for i in range(len(ids))]
    wanted = np.unique(np.concatenate(near))
    if not len(wanted):
        return most
    vectors = given.filter(F.col("vec_id").isin(wanted.tolist())).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    vector = {r["vec_id"]: r["vector"] for r in vectors.collect()}
    neighbours = _candidates(np.array([vector[i] for n in near for i in n.tolist()], dtype=np.float64), norm)
    of = np.repeat(np.arange(len(ids)), [len(n) for n in near])
    enough = (m for m in range(most, 0, -1) if share_held(_queries(x, norm), neighbours, of, m) >= TARGET)
    return next(enough, 0)


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, *, k: int = 20, query: Column | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    `vectors` has vec_id and embedding; `query` chooses the queries (default: vec_id divisible by 20).
    """
    query = F.col("vec_id") % 20 == 0 if query is None else query
    python_tasks(vectors.sparkSession)
    given = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    ).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
    squared = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sizes = given.groupBy(F.size("vector").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.sqrt(squared)).alias("norm")
    )
    most = sizes.orderBy(F.desc("n"), "d").first()
    dimension, rows, norm = (most["d"], most["n"], most["norm"]) if most else (1, 0, 1.0)
    if not rows:
        return _ranked(given.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")).limit(0), k)
    given = given.filter(F.size("vector") == dimension)
    functions = chosen_functions(given, given.filter(query), dimension, rows, norm, k)
    part_rows = max(1024, PART_BYTES // (8 * dimension))
    parts = max(1, -(-rows * TABLES // part_rows))
    indexed = given.mapInArrow(_index(dimension, functions, norm), "bucket bigint, vec_id bigint, vector array<double>")
    indexed = stored(indexed.withColumn("part", F.pmod("bucket", F.lit(parts))), "hashed-vectors")
    pieces = indexed.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.expr(f"cast((n + {part_rows - 1}) div {part_rows} as int)").alias("pieces")
    )
    pieces = stored(pieces, "pieces")
    # A piece for each part_rows rows of a part; a row's piece follows from its vec_id.
    points = indexed.join(pieces, "part").select(
        "part",
        F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int").alias("piece"),
        F.lit(0).alias("kind"),
        F.array("bucket").alias("buckets"),
        "vec_id",
        "vector",
    )
    asked = given.filter(query).mapInArrow(
        _probe(dimension, functions, norm, parts),
        "part bigint, buckets array<bigint>, vec_id bigint, vector array<double>",
    )
    probes = asked.join(pieces, "part").select(
        "part",
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
        F.lit(1).alias("kind"),
        "buckets",
        "vec_id",
        "vector",
    )
    found = (
        points.unionByName(probes)
        .repartition("part", "piece")
        .sortWithinPartitions("part", "piece", "kind")
        .mapInArrow(_compare(dimension, k), "query_id bigint, vec_id bigint, score double")
    )
    return _ranked(found, k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
