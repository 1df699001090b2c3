"""Spelling variants against brute force, and the generated neighbourhoods."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from tokenloom.llm import spelling
from tokenloom.llm.queries import QUERIES

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def want(docs):
    count = Counter()
    for i, text in docs:
        for run in RUNS.findall(text or ""):
            run = run.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    near = defaultdict(set)
    gaps = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1 :]
            gaps[k, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def check(spark, docs, found=None):
    if found is None:
        df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
        df = df.selectExpr("*", *[f"'x' as {c}" for c in ("word", "n", "run", "code", "near", "reduced", "root", "m")])
        found = spelling.group_variants(df).collect()
    assert sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in found) == want(docs)


def test_odd_texts(spark):
    long = "abcdefghij" * 3000
    docs = [
        (1, None), (2, ""), (3, "12 !? _"), (4, "Straße straße STRASSE Strase strase strase strasse strasse"),
        (5, f"{long} {long} {long} {long}z {long}z {long}z"), (6, f"{'q' * 6} " * 20 + f"{'q' * 5} " * 6 + f"{'q' * 7} " * 3),
        (None, "naïve naïve naïve naive naive naive naive naive naive naive"), (8, "words wordz " * 3 + "wards " * 6),
        (8, "words wordz " * 3 + "wards " * 6), (9, "×÷×÷×÷ " * 3 + "aaaaa\U0001f600bbbbb " * 3 + "ÀÉÎÕÜ ÀÉÎÕü " * 4),
    ]
    check(spark, docs)
    assert spelling.group_variants(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


@pytest.mark.parametrize("letters, sizes", [("ab", (4,)), ("abcdé", (2,)), ("abcdefghijklmnop", spelling.SIZES)])
def test_random_words(spark, monkeypatch, letters, sizes):
    monkeypatch.setattr(spelling, "SIZES", sizes)
    monkeypatch.setattr(spelling, "AT_ONCE", 64)
    rng = np.random.default_rng(len(letters))
    words = ["".join(rng.choice(list(letters), rng.integers(4, 9))) for _ in range(150)]
    words += [w[:k] + w[k + 1 :] for w in words[:40] for k in (0, 2)]
    docs = [(i, " ".join(words[k] for k in rng.zipf(1.3, 200) % len(words))) for i in range(20)]
    check(spark, docs)


def test_query_over_its_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(d["doc_id"], d["text"]) for d in brute.rows(folder, "documents")]
    check(spark, docs, QUERIES["op12_spelling"](spark, folder).collect())


def test_words_are_never_broadcast(spark, monkeypatch):
    """However small Spark reckons a side to be; with roots, forms and near words."""
    plans, store = [], spelling.stored

    def plan_of(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def noted(df, label):
        plans.append(plan_of(df))
        return store(df, label)

    monkeypatch.setattr(spelling, "stored", noted)
    docs = [(k, "wording " * 24 + "wordings " * 12 + "wordingss " * 6 + "swordingss " * 3) for k in range(4)]
    found = spelling.group_variants(spark.createDataFrame(docs, "doc_id bigint, text string"))
    joined = [p for p in [*plans, plan_of(found)] if "Join" in p]
    # Forms with the near words below them, two rounds of roots or more, and the result.
    assert len(joined) > 3 and not any("BroadcastExchange" in p for p in joined)
    check(spark, docs, found.collect())


def test_neighbourhoods_are_full():
    for word in ("a", "abba", "cabdacb"):
        letters = spelling.SYMBOLS[:4]
        edits = {word} | {word[:k] + word[k + 1 :] for k in range(len(word))}
        edits |= {word[:k] + c + word[k + d :] for k in range(len(word) + 1) for c in letters for d in (0, 1)}
        wanted = set(spelling.hashes(pa.array(sorted(edits))).tolist())
        (_, v), = spelling._matrices(pa.array([word]))
        found = spelling.neighbours(v, 4, np.arange(len(word) + 1))
        assert set(found[0].tolist()) == wanted and len(wanted) == len(edits)
