"""Exact duplicates against brute force, the codes, false suspects, and rounds of bits."""

from collections import defaultdict

import brute
import numpy as np
import pytest

from tokenloom.llm import common, exact_dedup
from tokenloom.llm.queries import QUERIES

EXTRA = ["file", "row", "word", "bits", "suspect", "text_sha256", "keep_id", "last", "n", "owner", "__hot"]
LONG = "lorem ipsum dolor " * 60_000
TEXTS = [
    (1, None), (2, ""), (3, "a"), (4, "A"), (5, "a"), (None, "a"), (6, "a "), (7, LONG), (8, LONG), (9, LONG + "x"),
    (10, "twice"), (10, "twice"), (10, "other"), (None, "no id"), (None, "no id"), (11, "东京"), (-3, "a"),
]


def want(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        own = groups[t or ""]
        ids = [x for x in own if x is not None]
        out.append((i, max(ids) if ids else None, len(own), brute.sha256(t or "")))
    return sorted(out, key=repr)


def check(found, rows):
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=repr) == want(rows)
    kept = [(r.text_sha256, r.doc_id) for r in found if r.kept]
    assert len(kept) == len({t for t, _ in kept}) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in found if r.kept)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return df.selectExpr("*", *[f"'x' as {c}" for c in EXTRA])


def test_odd_rows(spark):
    check(exact_dedup.find_copies(frame(spark, TEXTS)).collect(), TEXTS)
    assert exact_dedup.find_copies(frame(spark, TEXTS).limit(0)).collect() == []


@pytest.mark.parametrize("false_bits", [-4, 2])
def test_false_suspects_are_told_apart_by_their_bytes(spark, false_bits):
    rows = [(i, f"text {i % 70}") for i in range(200)] + TEXTS
    check(exact_dedup.find_copies(frame(spark, rows), false_bits=false_bits).collect(), rows)


@pytest.mark.parametrize("bound", [0, 1, 5])
def test_bits_are_broadcast_in_rounds_or_shuffled(spark, monkeypatch, bound, tmp_path):
    monkeypatch.setattr(common, "BROADCAST_ROWS", max(bound, 1))
    monkeypatch.setattr(common, "HOT_KEYS", bound)
    rows = [(i, f"text {i % 90}" if i % 3 else "hot") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    df.write.parquet(f"{tmp_path}/docs")
    check(exact_dedup.find_copies(exact_dedup.with_rows(spark.read.parquet(f"{tmp_path}/docs"))).collect(), rows)


def test_query_over_its_table(spark):
    rows = [(d["doc_id"], d["text"]) for d in brute.rows("/root/testdata/sf0.001", "documents")]
    check(QUERIES["op13_exact_dedup"](spark, "/root/testdata/sf0.001").collect(), rows)


def test_codes_round_trip():
    rng = np.random.default_rng(3)
    for n, top in ((0, 9), (1, 1), (1, 1 << 61), (500, 501), (4000, 1 << 45), (3, 1 << 20)):
        values = np.sort(rng.choice(top, n, replace=False) if top < 1 << 20 else np.unique(rng.integers(0, top, n)))
        start = int(values[0]) - int(values[0]) % 7 if n else 5
        coded = exact_dedup.golomb(values, start)
        assert exact_dedup.ungolomb(len(values), *coded, start).tolist() == values.tolist()
        if n > 1000:  # near the entropy of the gaps: log2(mean gap) + 1.5 bits
            assert 8 * (len(coded[1]) + len(coded[2])) < len(values) * (np.log2(top / n) + 2.5)
    starts = [exact_dedup.owner_start(o, 7, 12) for o in range(7)]
    assert starts[0] == 0 and all((s * 7) >> 12 == o and ((s - 1) * 7) >> 12 < o for o, s in enumerate(starts))
