"""Byte-level BPE through sentencepiece.

A rank table (token bytes -> rank) is turned into a sentencepiece BPE model without training:
every token's bytes are mapped to printable characters, one per byte, and become a piece scored
by its negative rank, so that the merge of lowest rank comes first; the normalisation is the
identity. The model is written directly in the protocol buffer wire format. A text is cut into
pre-tokens by the public pattern; each distinct pre-token is mapped, encoded and remembered. One
that is a token as a whole keeps that token, as byte-level encoders do. Decoding maps ids back
to bytes.

Defined cases: a null or empty text has no ids and decodes to no bytes; text that looks like a
special token is ordinary text; repeated rows are each encoded. Memory beside the batch is
bounded by MEMO_WORDS remembered pre-tokens of at most MEMO_LENGTH characters. Sentencepiece
takes time in proportion to n log n for a pre-token of n bytes.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import kept, python_tasks

MEMO_WORDS = 1 << 17
MEMO_LENGTH = 64
ROWS_AT_ONCE = 64


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where printable, else from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(others)) for b in range(256)]


# Wire format of the model's messages: field numbers are those of the public model schema.
def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _block(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _piece(text: str, score: float, kind: int) -> bytes:
    score_field = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, _block(1, text.encode()) + score_field + _number(3, kind))


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised model; piece i is the token of rank i, the unknown piece comes last."""
    ordered = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in ordered] != list(range(len(ordered))):
        raise ValueError("ranks must be 0, 1, 2, ...")
    if not all(bytes([b]) in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    letters = byte_characters()
    normal, unknown, bpe = 1, 2, 2
    pieces = [_piece("".join(letters[b] for b in t), -ranks[t], normal) for t in ordered]
    # Its name holds a space, which no mapped token does.
    pieces.append(_piece("<no token>", 0.0, unknown))
    trainer = (
        _number(3, bpe)
        + _number(4, len(pieces))
        + _number(40, len(ordered))  # unk_id; no other control pieces
        + b"".join(_number(f, (1 << 64) - 1) for f in (41, 42, 43))
    )
    # No dummy prefix, no removal of extra white space, no escaping of white space.
    normalizer = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normalizer)


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 of the token's bytes and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Codec:
    """Encoder and decoder over one rank table; holds at most MEMO_WORDS pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.table = {b: c for b, c in enumerate(byte_characters())}
        self.tokens = sorted(ranks, key=ranks.get)
        self.split = regex.compile(pattern).findall
        self.memo: dict[str, tuple[int, str, bytes]] = {}

    def word_ids(self, word: str) -> list[int]:
        data = word.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        return self.model.encode(data.decode("latin-1").translate(self.table))

    def entry(self, word: str) -> tuple[int, str, bytes]:
        """(number of ids, the ids in decimal, the bytes they decode to) of a pre-token."""
        found = self.memo.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = (len(ids), ",".join(map(str, ids)), self.decode(ids))
            if len(word) <= MEMO_LENGTH and len(self.memo) < MEMO_WORDS:
                self.memo[word] = found
        return found

    def encode(self, text: str) -> list[int]:
        return [int(i) for w in self.split(text) for i in self.entry(w)[1].split(",")]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded bytes)."""
        entries = [self.entry(w) for w in self.split(text)]
        ids = ",".join([e[1] for e in entries])
        decoded = b"".join([e[2] for e in entries])
        return (
            sum([e[0] for e in entries]),
            hashlib.sha256(ids.encode()).hexdigest(),
            hashlib.sha256(decoded).hexdigest(),
        )


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process; the file is read where the task runs."""
    return kept(("byte-bpe", path, pattern), lambda: Codec(load_ranks(path), pattern))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch["text"].to_pylist()]


def digest_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document."""
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for b in batches:
            rows = [own.digest(t) for t in _texts(b)]
            n, ids, decoded = zip(*rows) if rows else ((), (), ())
            columns = [b["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) with the token ids as an int array."""
    python_tasks(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for b in batches:
            for at in range(0, len(b), ROWS_AT_ONCE):
                part = b.slice(at, ROWS_AT_ONCE)
                ids = pa.array([own.encode(t) for t in _texts(part)], pa.list_(pa.int32()))
                yield pa.record_batch([part["doc_id"], ids], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, data) with the bytes that the ids stand for."""
    python_tasks(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for b in batches:
            data = pa.array([own.decode(i or []) for i in b["ids"].to_pylist()], pa.binary())
            yield pa.record_batch([b["doc_id"], data], ["doc_id", "data"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(
        run, f"doc_id {kind}, data binary"
    )
