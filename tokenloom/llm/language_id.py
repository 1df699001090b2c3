"""Language identification by segmentation-marginalised unigrams.

The pieces are a fixed public vocabulary. Each language gives every piece a probability; a
word's probability is the sum over all its segmentations into pieces of the product of theirs,
computed by the forward algorithm, and a text's is the product over its words. The piece
probabilities are fitted by expectation maximisation (forward-backward over the words of a
bounded sample of labelled rows, counted per language by Spark). The predicted language has the
largest posterior under equal priors, which is the score.

Texts are read as words: runs of characters other than ASCII white space, digits and
punctuation, A-Z lower-cased. Distinct words of a batch are scored once, vectorised over words,
and a worker remembers MEMO_WORDS of them.

Defined cases: a null text and one without a letter get `und` and score 0; a text with
letters but no word known to any language still gets the best posterior (ties go to the first
language in order); with no labelled row every text is `und`; empty tables give no rows. A very
long word takes time in proportion to its length times the longest piece.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import free_names, kept, python_tasks, stored, unsigned_share
from tokenloom.llm.words import RowMemo, mapped_bytes, small_batches, split_words

# Bound of the fitting sample: labelled rows per language, in expectation.
FIT_ROWS = 1500
ROUNDS = 2
# A character that is no piece, in every language; and what is added to a piece's count.
UNKNOWN, ADDED = 1e-7, 0.1
MOST_LANGUAGES = 500
MEMO_WORDS = 1 << 17
# Words of more letters are scored by segments; in fitting they count as several words.
LONG_WORD = 256
SEGMENTS, SEGMENT_LETTERS = 256, 256
BLOCK_WORDS = 1 << 14
UNDECIDED = "und"
MIN_SCORE = 0.3

MARK = "▁"
_TABLE = bytes(
    b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
_PRIME = np.uint64(0x100000001B3)


def pieces_of(path: str) -> list[str]:
    """The vocabulary's ordinary pieces, in order."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not any(test(i) for test in special)
    ]


class Lattice:
    """Segmentations of words into pieces, vectorised over words.

    Substrings are matched by a 64-bit rolling hash of their characters.
    """

    def __init__(self, pieces: list[str]):
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order.astype(np.int64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two pieces share a hash")
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[self._slot(hashes)] = True
        self.n = len(pieces)
        self.longest = max(map(len, pieces), default=1)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = ((h ^ ord(c)) * int(_PRIME) + 1) & ((1 << 64) - 1)
        return h

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)).astype(np.int64)

    def edges(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
        """(codes, lengths, edges): edges as (end, length, rows, piece ids) by end position.

        Words are sorted by the caller; `piece ids` holds n for an unknown character.
        """
        marked = [MARK + w for w in words]
        lengths = np.array([len(w) for w in marked], dtype=np.int64)
        width = int(lengths.max(initial=1))
        flat = np.frombuffer("".join(marked).encode("utf-32-le"), dtype=np.uint32)
        codes = np.zeros((width, len(words)), dtype=np.uint64)
        inside = np.arange(width)[:, None] < lengths[None, :]
        codes.T[inside.T] = flat
        found = []
        state: list[np.ndarray] = []
        for end in range(1, width + 1):
            here = np.flatnonzero(lengths >= end)
            letter = codes[end - 1]
            state = [(s ^ letter) * _PRIME + np.uint64(1) for s in state[max(0, len(state) - self.longest + 1) :]]
            state.append(letter * _PRIME + np.uint64(1))
            for back, s in enumerate(reversed(state)):
                rows = here[self.filter[self._slot(s[here])]]
                at = np.minimum(np.searchsorted(self.hashes, s[rows]), len(self.hashes) - 1)
                hit = self.hashes[at] == s[rows]
                rows, ids = rows[hit], self.ids[at[hit]]
                if back == 0:
                    known = np.zeros(len(words), dtype=bool)
                    known[rows] = True
                    lost = here[~known[here]]
                    rows = np.concatenate([rows, lost])
                    ids = np.concatenate([ids, np.full(len(lost), self.n, dtype=np.int64)])
                if len(rows):
                    found.append((end, back + 1, rows, ids))
        return codes, lengths, found

    def forward(self, words: list[str], probs: np.ndarray) -> np.ndarray:
        """Log probability of each word (rows) in each language (columns of `probs`)."""
        out = np.zeros((len(words), probs.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        if short:
            part = [words[i] for i in short]
            out[short] = self._by_length(part, lambda p: self._forward(p, probs)[0], probs.shape[1])
        for i, w in enumerate(words):
            if len(w) > LONG_WORD:
                out[i] = self._forward_long(w, probs)
        return out

    def _forward_long(self, word: str, probs: np.ndarray) -> np.ndarray:
        """The forward pass over one long word, a block of SEGMENTS segments at a time.

        What follows a position depends on the last `longest` forward values only, linearly. So
        all segments of a block advance side by side, each from every unit vector of these
        values, and the resulting matrices are then applied one after another.
        """
        text = np.frombuffer((MARK + word).encode("utf-32-le"), dtype=np.uint32)
        k, langs = self.longest, probs.shape[1]
        # Rows n and n + 1: an unknown character and no piece; n + 2: a step of certainty, for filling up.
        table = np.vstack([probs, np.full((1, langs), UNKNOWN), np.zeros((1, langs)), np.ones((1, langs))])
        state = np.zeros((k, langs))
        state[0] = 1.0
        logs = np.zeros(langs)
        for start in range(0, len(text), SEGMENTS * SEGMENT_LETTERS):
            ids = self._piece_ids(text, start, min(start + SEGMENTS * SEGMENT_LETTERS, len(text)))
            fill = -ids.shape[1] % SEGMENT_LETTERS
            filled = np.full((k, fill), self.n + 1, dtype=ids.dtype)
            filled[0] = self.n + 2
            ids = np.concatenate([ids, filled], axis=1).reshape(k, -1, SEGMENT_LETTERS)
            # last[j]: the values j positions back, as (segment, unit vector, language).
            last = np.zeros((k, ids.shape[1], k, langs))
            last[np.arange(k), :, np.arange(k)] = 1.0
            scale = np.zeros((ids.shape[1], langs))
            for step in range(SEGMENT_LETTERS):
                weights = table[ids[:, :, step]]
                now = np.einsum("ksl,ksul->sul", weights, last)
                last = np.concatenate([now[None], last[:-1]])
                if step % 8 == 7 or step == SEGMENT_LETTERS - 1:
                    top = np.maximum(last.max(axis=(0, 2)), 1e-300)
                    last /= top[None, :, None, :]
                    scale += np.log(top)
            for segment in range(ids.shape[1]):
                state = np.einsum("kul,ul->kl", last[:, segment], state)
                top = np.maximum(state.max(axis=0), 1e-300)
                state /= top
                logs += np.log(top) + scale[segment]
        return np.log(np.maximum(state[0], 1e-300)) + logs

    def _piece_ids(self, text: np.ndarray, start: int, stop: int) -> np.ndarray:
        """(length - 1, position): the piece of each length that ends after each of text[start:stop]."""
        begin = max(start - self.longest + 1, 0)
        letters = text[begin:stop].astype(np.uint64)
        out = np.full((self.longest, stop - start), self.n + 1, dtype=np.int32)
        h = np.zeros(len(letters), dtype=np.uint64)
        for length in range(1, min(self.longest, len(letters)) + 1):
            h = (h[: len(letters) - length + 1] ^ letters[length - 1 :]) * _PRIME + np.uint64(1)
            at = np.flatnonzero(self.filter[self._slot(h)])
            found = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
            hit = self.hashes[found] == h[at]
            ends = at[hit] + begin + length - 1 - start
            inside = ends >= 0
            out[length - 1, ends[inside]] = self.ids[found[hit]][inside]
        out[0][out[0] > self.n] = self.n
        return out

    def _by_length(self, words: list[str], run, columns: int) -> np.ndarray:
        out = np.zeros((len(words), columns))
        order = np.argsort([len(w) for w in words], kind="stable")
        at = 0
        while at < len(order):
            longest = len(words[order[min(at + BLOCK_WORDS, len(order)) - 1]]) + 1
            step = max(1, min(BLOCK_WORDS, (BLOCK_WORDS * 32) // longest))
            rows = order[at : at + step]
            out[rows] = run([words[i] for i in rows])
            at += step
        return out

    def _forward(self, words: list[str], probs: np.ndarray):
        """Scaled forward pass: (log totals, forward values by position, log scales)."""
        _, lengths, edges = self.edges(words)
        width, n, langs = int(lengths.max(initial=1)), len(words), probs.shape[1]
        table = np.vstack([probs, np.full((1, langs), UNKNOWN)])
        values = [np.zeros((n, langs)) for _ in range(width + 1)]
        scales = np.zeros((width + 1, n))
        values[0][:] = 1.0
        totals = np.zeros((n, langs))
        by_end: dict[int, list[tuple]] = {}
        for edge in edges:
            by_end.setdefault(edge[0], []).append(edge)
        for end in range(1, width + 1):
            now = values[end]
            for _, length, rows, ids in by_end.get(end, ()):
                start = end - length
                # Values are kept relative to a common scale per word and position.
                shift = np.exp(scales[start, rows] - scales[end - 1, rows])
                now[rows] += values[start][rows] * table[ids] * shift[:, None]
            top = now.max(axis=1)
            live = top > 0
            scales[end] = scales[end - 1]
            scales[end, live] += np.log(top[live])
            now[live] /= top[live, None]
            done = np.flatnonzero(lengths == end)
            totals[done] = np.log(np.maximum(now[done], 1e-300)) + scales[end, done, None]
        return totals, (values, scales, edges, table)

    def expected(self, words: list[str], counts: np.ndarray, lang: np.ndarray, probs: np.ndarray):
        """Expected piece counts (pieces x languages) of words, ascending in length, that each belong
        to a language."""
        out = np.zeros((self.n + 1, probs.shape[1]))
        at, step = 0, 0
        while (at := at + step) < len(words):
            longest = len(words[min(at + BLOCK_WORDS, len(words)) - 1]) + 1
            step = max(1, min(BLOCK_WORDS, (BLOCK_WORDS * 32) // longest))
            part = words[at : at + step]
            own, weight = lang[at : at + step], counts[at : at + step]
            totals, (values, scales, edges, table) = self._forward(part, probs)
            mine = totals[np.arange(len(part)), own]
            lengths = np.array([len(w) + 1 for w in part])
            back = np.full((len(values), len(part)), -np.inf)
            back[lengths, np.arange(len(part))] = 0.0
            for end, length, rows, ids in reversed(edges):
                start, langs = end - length, own[rows]
                tail = np.log(table[ids, langs]) + back[end, rows]
                head = np.log(np.maximum(values[start][rows, langs], 1e-300)) + scales[start, rows]
                share = np.exp(head + tail - mine[rows])
                np.add.at(out, (ids, langs), share * weight[rows])
                back[start, rows] = np.logaddexp(back[start, rows], tail)
        return out[: self.n]


def lattice(path: str) -> Lattice:
    """One lattice per worker process; the file is read where the task runs."""
    return kept(("lattice", path), lambda: Lattice(pieces_of(path)))


def _fit_words(sample: DataFrame) -> DataFrame:
    """(lang, word, n) over the sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            codes, words, offsets = split_words(mapped_bytes(b["text"], _TABLE))
            langs, lang_of = np.unique(np.array(b["lang"].to_pylist(), dtype=object), return_inverse=True)
            owner = np.repeat(lang_of, np.diff(offsets))
            keys, n = np.unique(owner * max(len(words), 1) + codes, return_counts=True)
            yield pa.record_batch(
                [
                    pa.array(langs[keys // max(len(words), 1)], pa.string()),
                    words.take(pa.array(keys % max(len(words), 1))).cast(pa.string()),
                    pa.array(n, pa.int64()),
                ],
                ["lang", "word", "n"],
            )

    counted = sample.select("text", "lang").mapInArrow(run, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(
    labelled: DataFrame, vocabulary: str, *, fit_rows: int = FIT_ROWS, rounds: int = ROUNDS
) -> tuple[list[str], np.ndarray]:
    """(languages, probabilities: piece x language) from (doc_id, text, lang).

    Rows without a language are left out. What the driver holds is one number per piece and
    language; more than MOST_LANGUAGES languages are refused.
    """
    python_tasks(labelled.sparkSession)
    known = labelled.filter(F.col("lang").isNotNull())
    per_lang = known.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(per_lang) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(r["lang"] for r in per_lang)
    size = len(pieces_of(vocabulary))
    probs = np.full((size, len(langs)), 1.0 / size)
    if not langs:
        return langs, probs
    share = {r["lang"]: min(1.0, fit_rows / r["count"]) for r in per_lang}
    rate = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("lang"))
    draw = unsigned_share(F.xxhash64(F.lit("fit"), "doc_id"))
    sample = known.filter(draw < rate).filter(F.col("text").isNotNull())
    words = stored(_fit_words(sample), "lang-words")
    number = {x: i for i, x in enumerate(langs)}
    for _ in range(rounds):
        gathered = _expectation(words, vocabulary, number, probs).collect()
        counts = np.zeros_like(probs)
        for row in gathered:
            counts[row["piece"], row["lang"]] = row["n"]
        probs = (counts + ADDED) / (counts.sum(axis=0) + ADDED * size)
    return langs, probs


def _expectation(words: DataFrame, vocabulary: str, number: dict, probs: np.ndarray) -> DataFrame:
    held = words.sparkSession.sparkContext.broadcast(probs.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value.astype(np.float64)
        total = np.zeros_like(table)
        for b in batches:
            cut = [[w[i : i + LONG_WORD] for i in range(0, len(w), LONG_WORD)] for w in b["word"].to_pylist()]
            times = [len(c) for c in cut]
            text = [w for c in cut for w in c]
            order = np.argsort([len(w) for w in text], kind="stable")
            lang = np.repeat(np.array([number[x] for x in b["lang"].to_pylist()], dtype=np.int64), times)
            n = np.repeat(np.asarray(b["n"], dtype=np.float64), times)
            total += lattice(vocabulary).expected([text[i] for i in order], n[order], lang[order], table)
        piece, lang = np.nonzero(total)
        columns = [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])]
        yield pa.record_batch(columns, ["piece", "lang", "n"])

    found = words.mapInArrow(run, "piece int, lang int, n double")
    return found.groupBy("piece", "lang").agg(F.sum("n").alias("n"))


def predict(
    docs: DataFrame,
    vocabulary: str,
    langs: list[str],
    probs: np.ndarray,
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """`docs` with the predicted language and its score as `names`; only the text is looked at."""
    python_tasks(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(probs.astype(np.float32))
    model = hashlib.sha256(probs.tobytes()).hexdigest()
    schema = docs.select("*").schema.add(names[0], "string").add(names[1], "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value.astype(np.float64)
        own = lattice(vocabulary)
        memo = kept(
            ("word scores", vocabulary, model),
            lambda: RowMemo(lambda w: own.forward(w, table).astype(np.float32), MEMO_WORDS),
        )
        labels = np.array([*langs, UNDECIDED], dtype=object)
        for b in small_batches(batches):
            best, score = _best(b["text"], memo, len(langs))
            added = [pa.array(labels[best], pa.string()), pa.array(score, pa.float64())]
            yield pa.record_batch([*b.columns, *added], [*b.schema.names, *names])

    return docs.mapInArrow(run, schema)


def _best(texts: pa.Array, memo: RowMemo, langs: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language, its posterior); `langs` itself for an undecided text."""
    lettered = np.asarray(pc.match_substring_regex(texts.fill_null(""), r"\p{L}"), dtype=bool)
    if not langs:
        return np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
    codes, words, offsets = split_words(mapped_bytes(texts, _TABLE))
    values = memo(words.to_pylist())[codes].astype(np.float64)
    sums = np.zeros((len(values) + 1, langs))
    np.cumsum(values, axis=0, out=sums[1:])
    likely = sums[offsets[1:]] - sums[offsets[:-1]]
    likely -= likely.max(axis=1, keepdims=True)
    posterior = np.exp(likely)
    posterior /= posterior.sum(axis=1, keepdims=True)
    best = np.where(lettered, likely.argmax(axis=1), langs)
    return best, np.where(lettered, posterior.max(axis=1), 0.0)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document.

    Fitted on the documents that are not held out (a null doc_id is not held out).
    """
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    langs, probs = fit(docs.select("doc_id", "text", "lang").filter(~out), vocabulary)
    found = predict(docs.select("doc_id", out.alias("held_out"), "text"), vocabulary, langs, probs)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, vocabulary: str, min_score: float = MIN_SCORE) -> DataFrame:
    """`docs` without the undecided texts and those whose score is under `min_score`."""
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    langs, probs = fit(docs.select("doc_id", "text", "lang").filter(~out), vocabulary)
    lang, score = free_names(docs, "lang_pred", "score")
    found = predict(docs, vocabulary, langs, probs, (lang, score))
    return found.filter((F.col(lang) != UNDECIDED) & (F.col(score) >= min_score)).select(*docs.columns)
