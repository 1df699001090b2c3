"""Words of Arrow text batches as dictionary codes, and memos over distinct words."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text bytes worked on at once: bounds the arrays built beside a batch.
SLICE_BYTES = 1 << 22


def small_batches(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `most` bytes of text, or of one longer text."""
    for b in batches:
        ends = np.cumsum(np.asarray(pc.binary_length(b[column]).fill_null(0), dtype=np.int64))
        start = 0
        while start < len(ends):
            limit = (int(ends[start - 1]) if start else 0) + most
            stop = max(start + 1, int(np.searchsorted(ends, limit, side="right")))
            yield b.slice(start, stop - start)
            start = stop


def mapped_bytes(texts: pa.Array, table: bytes) -> pa.Array:
    """`texts` with every byte replaced by table[byte]; nulls become empty texts.

    The table must keep bytes from 128 on, so the result stays valid UTF-8.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    if not len(texts) or data is None:
        return texts
    start, end = int(offsets[0]), int(offsets[-1])
    changed = data.slice(start, end - start).to_pybytes().translate(table)
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - start).tobytes()), pa.py_buffer(changed)
    )


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(codes of all words in order, the distinct words, offset of each text's first word).

    Words are the runs between ASCII white space, empty ones left out.
    """
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    flat = lists.values
    filled = np.asarray(pc.greater(pc.binary_length(flat), 0))
    kept = np.concatenate([[0], np.cumsum(filled)]).astype(np.int64)
    if not filled.all():
        flat = flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    return np.asarray(coded.indices, dtype=np.int64), coded.dictionary, kept[offsets]


class RowMemo:
    """Remembered rows of a word function, at most `most` words of at most `longest` bytes.

    `compute` turns a list of words into an array with a row per word.
    """

    def __init__(self, compute: Callable[[list[str]], np.ndarray], most: int, longest: int = 64):
        self.compute, self.most, self.longest = compute, most, longest
        self.known: dict[str, int] = {}
        self.rows: np.ndarray | None = None

    def __call__(self, words: list[str]) -> np.ndarray:
        at = np.array([self.known.get(w, -1) for w in words], dtype=np.int64)
        missing = np.flatnonzero(at < 0)
        new = self.compute([words[i] for i in missing]) if len(missing) or self.rows is None else None
        if self.rows is None:
            self.rows = np.empty((1 << 12, *new.shape[1:]), dtype=new.dtype)
        out = np.empty((len(words), *self.rows.shape[1:]), dtype=self.rows.dtype)
        old = np.flatnonzero(at >= 0)
        out[old] = self.rows[at[old]]
        if new is not None:
            out[missing] = new
            self._remember(words, missing, new)
        return out

    def _remember(self, words: list[str], missing: np.ndarray, new: np.ndarray) -> None:
        n = len(self.known)
        keep = [k for k, i in enumerate(missing) if len(words[i]) <= self.longest][: self.most - n]
        if n + len(keep) > len(self.rows):
            larger = min(self.most, max(2 * len(self.rows), n + len(keep)))
            grown = np.empty((larger, *self.rows.shape[1:]), dtype=self.rows.dtype)
            grown[:n] = self.rows[:n]
            self.rows = grown
        for k in keep:
            self.known[words[missing[k]]] = n
            self.rows[n] = new[k]
            n += 1
