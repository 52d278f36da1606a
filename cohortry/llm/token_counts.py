"""Token counts of a unigram vocabulary by a count-only Viterbi pass (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortry.llm.tables import small_batches
from cohortry.llm.words import WordTable, eights, text_runs

MARK = "▁"
#: What an unknown character costs below the lowest score of the vocabulary (a fixed value of unigram tokenizers).
UNKNOWN_PENALTY = 10.0
#: Bounds of the words that a worker keeps.
WORDS_KEPT = 500_000
BYTES_KEPT = 32 << 20
#: Words of more characters, with the mark, are segmented one by one, shorter ones all at once.
LONG_WORD = 40


def zipf_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece model with log probabilities that fall as 1/(rank + 1).

    Control pieces and byte pieces are left out; the order of the file is the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(k) for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    mass = np.log(np.sum(1.0 / (1.0 + np.arange(len(pieces)))))
    return [(p, float(-np.log(1.0 + k) - mass)) for k, p in enumerate(dict.fromkeys(pieces))]


class Counter:
    """Number of pieces of the best segmentation of a word, by the rules of unigram tokenizers.

    Aho-Corasick enumerates every vocabulary match of the word. For each end position the programme
    keeps the best score and the pieces on that path. Matches are tried by growing start, and only a
    strictly better score replaces one that stands, so of equal paths the one with the longest last
    piece wins. A character that no one-character piece covers may also be unknown, tried after the
    matches that start with it; unknowns in a row count as one piece.
    """

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        self.single = set()
        self.lengths, self.scores = np.array([len(p) for p, _ in vocabulary], np.int64), np.array([s for _, s in vocabulary], float)
        for k, (piece, _) in enumerate(vocabulary):
            self.automaton.add_word(piece, k)
            if len(piece) == 1:
                self.single.add(piece)
        self.empty = not vocabulary
        if not self.empty:
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self._clear()

    def _clear(self) -> None:
        self.words = WordTable()
        self.known = np.zeros(1 << 14, np.int32)

    def pieces(self, word: str) -> int:
        n = len(word)
        by_end: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        if not self.empty:
            for last, piece in self.automaton.iter(word):
                by_end[last + 1].append((int(self.lengths[piece]), float(self.scores[piece])))
        best = [0.0] + [None] * n
        count = [0] * (n + 1)
        unknown_last = [False] * (n + 1)
        for end in range(1, n + 1):
            top, pieces, odd = None, 0, False
            for length, score in sorted(by_end[end], reverse=True):
                start = end - length
                total = best[start] + score
                if top is None or total > top:
                    top, pieces, odd = total, count[start] + 1, False
            if word[end - 1] not in self.single:
                total = best[end - 1] + self.unknown
                if top is None or total > top:
                    top, pieces, odd = total, count[end - 1] + (not unknown_last[end - 1]), True
            best[end], count[end], unknown_last[end] = top, pieces, odd
        return count[n]

    def pieces_of(self, words: list[str]) -> np.ndarray:
        """``pieces`` of many words at once: the programme takes one step of one length for all words that have such a match."""
        out = np.zeros(len(words), np.int64)
        sizes = np.array([len(w) for w in words], np.int64)
        for k in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[k] = self.pieces(words[k])
        short = np.flatnonzero(sizes <= LONG_WORD)
        if not len(short):
            return out
        sizes, text = sizes[short], "".join(words[k] for k in short)
        firsts = np.concatenate([[0], np.cumsum(sizes)])
        width = int(sizes.max())
        best = np.full((width + 1, len(short)), -np.inf)
        count = np.zeros((width + 1, len(short)), np.int64)
        odd_last = np.zeros((width + 1, len(short)), bool)
        best[0] = 0.0
        found = np.zeros((0, 2), np.int64) if self.empty else np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        word = np.repeat(np.arange(len(short)), sizes)[found[:, 0]]
        end, length = found[:, 0] + 1 - firsts[word], self.lengths[found[:, 1]]
        # a match that begins in the word before is none; the others in the order of their ends, then of growing start
        order = np.flatnonzero(length <= end)
        key = (end[order] * (LONG_WORD + 1) - length[order]).astype(np.int16)
        sort = np.argsort(key, kind="stable")
        order, key = order[sort], key[sort]
        edges = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]]) if len(key) else np.zeros(1, np.int64)
        groups: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(width + 1)]
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            groups[int(end[order[a]])].append((int(length[order[a]]), order[a:b]))
        letters = np.array(list(text), "U1")
        covered = np.isin(letters, np.array(sorted(self.single), "U1")) if self.single else np.zeros(len(letters), bool)
        for at in range(1, width + 1):
            for size, these in groups[at]:
                w = word[these]
                total = best[at - size, w] + self.scores[found[these, 1]]
                better = total > best[at, w]
                w, total = w[better], total[better]
                best[at, w] = total
                count[at, w] = count[at - size, w] + 1
            live = np.flatnonzero(sizes >= at)
            live = live[~covered[firsts[live] + at - 1]]
            total = best[at - 1, live] + self.unknown
            live, total = live[total > best[at, live]], total[total > best[at, live]]
            best[at, live] = total
            count[at, live] = count[at - 1, live] + ~odd_last[at - 1, live]
            odd_last[at, live] = True
        out[short] = count[sizes, np.arange(len(short))]
        return out

    def count(self, text: str) -> int:
        """Pieces of a text; it gets a mark in front, blanks become marks, and every mark begins a word."""
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if text[0] != MARK:
            text = MARK + text
        return sum(self.pieces(MARK + word) for word in text.split(MARK)[1:])

    def _learn(self, words: list[bytes]) -> None:
        # a mark inside a word begins another one
        parts = [MARK + w.decode() for w in words]
        marked = [k for k, p in enumerate(parts) if MARK in p[1:]]
        found = self.pieces_of(["" if MARK in p[1:] else p for p in parts])
        for k in marked:
            found[k] = sum(self.pieces(MARK + p) for p in parts[k].split(MARK)[1:])
        at, new = len(self.words), len(words)
        while at + new > len(self.known):
            self.known = np.concatenate([self.known, np.zeros_like(self.known)])
        self.known[at : at + new] = found

    def count_column(self, column: pa.Array) -> np.ndarray:
        """``count`` of every text of a column; each different word is segmented once."""
        out = np.zeros(len(column), np.int64)
        mark = np.frombuffer(MARK.encode(), np.uint8)
        for first, text, offsets in text_runs(column):
            if len(self.words) > WORDS_KEPT or self.words.size > BYTES_KEPT:
                self._clear()
            blank = np.flatnonzero(text == 32)
            heads = offsets[:-1][offsets[1:] > offsets[:-1]]
            own = heads[text[heads] != 32]
            # a word begins after every blank, and where a text begins without one; it may be empty
            of = np.searchsorted(offsets, np.concatenate([blank, own]), "right") - 1
            starts = np.concatenate([blank + 1, own])
            ends = np.minimum(np.append(blank, len(text))[np.searchsorted(blank, starts)], offsets[of + 1])
            places = self.words.places(eights(text), starts, ends - starts, self._learn)
            marked = heads[(text[np.minimum(heads[:, None] + np.arange(3), len(text) - 1)] == mark).all(axis=1)] if len(heads) else heads
            alone = np.arange(len(offsets) - 1) if places is None else np.searchsorted(offsets, marked, "right") - 1
            if places is not None:
                out[first : first + len(offsets) - 1] = np.bincount(of, weights=self.known[places], minlength=len(offsets) - 1).astype(np.int64)
            # a text that begins with a mark gets none in front
            for k in alone.tolist():
                out[first + k] = self.count(text[offsets[k] : offsets[k + 1]].tobytes().decode())
        return out


@lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(zipf_vocabulary(path))


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id and n_tokens long, the pieces of the whole text under the vocabulary of ``path``.

    Null and empty text have 0 pieces; a null key is kept; repeated rows count alike; no rows give none.
    Nothing is shuffled, and memory is bounded by the longest text and the words kept.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_tokens", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counter.count_column(batch.column("text")))], names=["doc_id", "n_tokens"])

    return small_batches(rows).mapInArrow(count, schema)
