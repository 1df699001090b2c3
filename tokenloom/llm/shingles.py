"""Word shingles of whole texts as 64-bit hashes, vectorised over Arrow batches.

Words are the runs of bytes other than U+0020 and U+0009 to U+000D; A-Z count as a-z. A text
with at least `width` words has the distinct runs of `width` consecutive words as its set, one
with fewer words the whole sequence as its only element, one without words the empty set.

Two different shingles share a hash with probability 2**-64; nothing else is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tokenloom.llm.common import kept

WIDTH = 5
# Bytes hashed at once: bounds the memory beside the texts themselves.
PIECE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    return _powers(BASE, PIECE_BYTES + 1), _powers(INVERSE, PIECE_BYTES + 1)


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _piece_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word; no word crosses a position in `starts`."""
    space = _is_space(data)
    word = ~space
    begins = word.copy()
    begins[1:] &= space[:-1]
    ends = word.copy()
    ends[:-1] &= space[1:]
    inner = starts[(starts > 0) & (starts < len(data))]
    begins[inner] = word[inner]
    ends[inner - 1] = word[inner - 1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends)
    upper = (data >= 65) & (data <= 90)
    values = (data + (upper.view(np.uint8) << 5)).astype(np.uint64) + np.uint64(1)
    if len(data) > PIECE_BYTES:
        up, down = _powers(BASE, len(data) + 1), _powers(INVERSE, len(data) + 1)
    else:
        up, down = kept(("powers",), _tables)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(data)], out=total[1:])
    return mixed((total[last + 1] - total[first]) * down[first]), first


def _pieces(data: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of `data` near PIECE_BYTES: at a text's start or between two words."""
    at = 0
    while at < len(data):
        end = min(at + PIECE_BYTES, len(data))
        if end < len(data):
            k = np.searchsorted(starts, end, side="right") - 1
            if starts[k] > at:
                end = int(starts[k])
            else:  # inside one long text: go back, or else on, to white space
                window = np.flatnonzero(_is_space(data[at:end]))
                if len(window):
                    end = at + int(window[-1]) + 1
                else:
                    stop = int(starts[k + 1]) if k + 1 < len(starts) else len(data)
                    more = np.flatnonzero(_is_space(data[end:stop]))
                    end = end + int(more[0]) if len(more) else stop
        yield at, end
        at = end


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array, nulls as empty texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(texts) == 0:
        return data[:0], np.zeros(1, dtype=np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, offset of each text's first word and the end)."""
    data, offsets = _buffers(texts)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for a, b in _pieces(data, offsets[:-1]):
        h, first = _piece_words(data[a:b], offsets[:-1] - a)
        hashes.append(h)
        places.append(first + a)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), offsets)


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, offsets = word_hashes(texts)
    n = max(len(words) - width + 1, 0)
    rows = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        rows += words[k : k + n] * np.uint64(2 * k + 3) ** np.uint64(width)
        rows = (rows << np.uint64(7)) | (rows >> np.uint64(57))
    rows = mixed(rows)
    sets = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= width:
            sets.append(np.unique(rows[a : b - width + 1]))
        elif b > a:
            whole = np.full(1, b - a, dtype=np.uint64)
            for i in range(a, b):
                whole = mixed(whole * BASE + words[i : i + 1])
            sets.append(whole)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets
