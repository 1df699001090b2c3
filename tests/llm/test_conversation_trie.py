"""The conversation trie against brute force, its double array, and divided conversations."""

import re
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import common, conversation_trie as trie
from tokenloom.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def content(role, text):
    """What orders equal turn numbers: the operator's own hashes, as it documents."""
    return HASHES[role or "", text or ""]


HASHES = {}


def want(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, content(role, text), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        leaves = sum(sums[x][0] for x in children[node]) or 1
        own_saved = (len(members[node]) - 1) * len(WORDS.findall(node[-1][1])) if node else 0
        sums[node] = leaves, own_saved + sum(sums[x][1] for x in children[node])
    return sorted(
        (
            min(cs), len(node), min(members[node[:-1]]) if node else -1, len(cs), len(children[node]), *sums[node],
            brute.sha256(",".join(map(str, sorted(ends[node])))),
        )
        for node, cs in members.items()
    )


def learn_hashes(df):
    role, text = F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    found = df.select(role, text).distinct().select("role", "text", F.xxhash64("role", "text").alias("d"))
    HASHES.update({(r.role, r.text): r.d for r in found.collect()})


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    learn_hashes(df)
    df = df.selectExpr("*", *[f"'x' as {c}" for c in ("pos", "d", "k1", "part", "words", "shard", "h", "base", "run")])
    found = trie.prefix_trie(df).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in found) == want(rows)


def random_rows(n, turns, texts, seed):
    rng = np.random.default_rng(seed)
    return [
        (2000 + c, t, "user" if t % 2 == 0 else "assistant", f"say {' w' * int(x)}")
        for c in range(n)
        for t, x in enumerate(rng.integers(0, texts, rng.integers(1, turns + 1)))
    ]


ODD = [
    (1, None, "user", "first"), (1, 0, None, "second"), (1, 0, "user", None), (2, 5, "a", "tie"), (2, 5, "a", "tie"),
    (2, 5, "b", "tie"), (None, 0, "user", "nobody"), (40, 0, "user", " \t\n"), (41, 0, "user", "x" * 100_000),
    (43, 7, "user", "own only"), (44, 1, "user", "one"), (-5, 0, "user", "neg"), (-21, 0, "user", "neg"), (-20, 0, "u", "b"),
    (60, 0, "user", "short base"), (61, 0, "user", "q"), (61, 1, "assistant", "r"), (61, 2, "user", "s"), (61, 3, "user", "t"),
    (62, 0, "user", "q"), (62, 1, "assistant", "r"), (62, 2, "user", "s"), (62, 3, "user", "t"),
]


def test_odd_rows(spark):
    check(spark, ODD)
    empty = spark.createDataFrame([], SCHEMA)
    assert trie.prefix_trie(empty).collect() == []
    check(spark, [(4, 0, "user", "hi")])


@pytest.mark.parametrize("segment, shard, ends", [(1 << 12, 1 << 17, 1 << 16), (2, 1 << 17, 2), (4, 8, 4), (1 << 12, 6, 1)])
def test_divided_conversations_and_first_turns(spark, monkeypatch, segment, shard, ends):
    monkeypatch.setattr(trie, "SEGMENT", segment)
    monkeypatch.setattr(trie, "SHARD_TURNS", shard)
    monkeypatch.setattr(trie, "ENDS_AT_ONCE", ends)
    monkeypatch.setattr(trie, "TURNS_PER_PART", 16)
    rows = random_rows(70, 11, 2, segment) + [(500 + i, t, "user", "same") for i in range(30) for t in range(9)]
    check(spark, rows + [(900, t, "user", f"long {t % 3}") for t in range(150)] + ODD)


def test_hot_parents_are_broadcast_or_shuffled(spark, monkeypatch):
    monkeypatch.setattr(trie, "SHARD_TURNS", 8)
    monkeypatch.setattr(common, "HOT_KEYS", 2)
    check(spark, random_rows(120, 4, 12, 3))


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in brute.rows(folder, "conversations")]
    learn_hashes(spark.read.parquet(f"{folder}/conversations.parquet"))
    found = QUERIES["op11_conversation_trie"](spark, folder).collect()
    assert sorted(tuple(-1 if v is None else v for v in r) for r in found) == want(rows)


def test_double_array_holds_its_sequences_and_no_others():
    rng = np.random.default_rng(1)
    for alphabet, n, longest in ((3, 200, 7), (500, 300, 4), (4000, 3000, 3), (2, 1, 300)):
        sequences = [rng.integers(0, alphabet, rng.integers(1, longest + 1)) for _ in range(n)]
        da = trie.DoubleArray.of(sequences)
        prefixes = {tuple(s[:d]) for s in sequences for d in range(len(s) + 1)}
        assert (da.check >= 0).sum() == len(prefixes) - 1 and len(da.check) < 2 * len(prefixes) + alphabet
        states = {(): 0}
        for p in sorted(prefixes - {()}, key=len):
            states[p] = int(da.step(np.array([states[p[:-1]]]), np.array([p[-1]]))[0])
        assert len(set(states.values())) == len(prefixes)
        for p, s in states.items():
            for x in range(min(alphabet, 20)):
                if (*p, x) not in prefixes:
                    with pytest.raises(KeyError):
                        da.step(np.array([s]), np.array([x]))
