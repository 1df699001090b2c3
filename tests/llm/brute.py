"""Plain Python versions of the operators' results, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
NAME = "(?:" + "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    for w in ("password", "passwd", "secret", "token", "api_?key")
) + ")"
ASSIGN = re.compile(NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def rows(sf_dir: str, table: str) -> list[dict]:
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


def shingles(text: str | None) -> set:
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(texts: list[str | None], threshold: int = 75) -> list[int]:
    """The number of each text's component: the index of its first text."""
    sets = [shingles(t) for t in texts]
    lists = defaultdict(list)
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, own in enumerate(sets):
        shared: dict[int, int] = defaultdict(int)
        for s in own:
            for j in lists[s]:
                shared[j] += 1
            lists[s].append(i)
        for j, n in shared.items():
            if 100 * n >= threshold * (len(own) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def leaks(texts: list[str | None], items: list[str | None]) -> set[tuple[int, int]]:
    wanted = [shingles(t) for t in items]
    found = set()
    for i, text in enumerate(texts):
        own = shingles(text)
        found |= {(i, j) for j, q in enumerate(wanted) if q and 4 * len(own & q) >= 3 * len(q)}
    return found


def secret_spans(text: str | None) -> list[tuple[int, int, str]]:
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, z, ("assign", "access", "hex")[k]) for a, k, z in sorted(found)]


def span_text(text: str | None) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, z, k in secret_spans(text))


@lru_cache
def byte_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@lru_cache
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def token_rows(docs: list[dict]) -> dict:
    """doc_id -> (start, n_tokens, crc) in ascending order of doc_id."""
    out, at = {}, 0
    for d in sorted(docs, key=lambda d: d["doc_id"]):
        ids = word_tokenizer().encode(d["text"] or "", add_special_tokens=False).ids + [2]
        out[d["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def nearest(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, k: int) -> list[list[int]]:
    out = []
    for q in queries:
        scores = x @ x[q]
        order = np.lexsort((ids, -scores))
        out.append([int(ids[i]) for i in order if ids[i] != ids[q]][:k])
    return out
