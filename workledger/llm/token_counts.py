"""Token counts of a unigram model by dynamic programming over a shared trie.

Distinct pre-tokens (words with the mark of a word's begin) are inserted in a trie
of characters. A node holds the forward score of its prefix, the best sum of
piece scores that ends there, and the number of pieces of that best path, so
words with a common prefix share the work for it. Where a word ends, its count
is stored; a document's count is the sum over its words.

A tokenizer file gives the pieces. Their scores, logarithms of chances, are
estimated by expectation-maximisation over the words of all documents: words
are counted once, in a distributed aggregation, and in each round the forward and
backward sums over the same trie give how often each piece is expected. A round
sends one number per piece to the driver. The start is the pieces' order of use. A
character in no piece is as many tokens as it has UTF-8 bytes, each scored below every piece.

Defined cases: null and empty texts have no tokens; of equally good paths the one
with fewer pieces counts; equal texts get equal counts; a very long word is
worked out without entering the trie; an empty table gives an empty result. Output
columns replace input columns of the same names.
"""

from __future__ import annotations

import gc
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from workledger.llm.common import Lookup, append_columns, portable
from workledger.session import materialize

BEGIN = "▁"  # the mark of a word's begin in the public vocabulary
UNKNOWN_PENALTY = 10.0
LONG_WORD = 256
AT_ONCE = 1 << 14
REMEMBERED = 120_000
TEXT_CHARS = 1 << 18
ROUNDS = 3
#: Times that a piece counts as seen besides, so that none is impossible.
UNSEEN = 0.1
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
OUTPUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])


def read_pieces(path: str) -> list[str]:
    """Ordinary pieces of a sentencepiece file, in order of use."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    return [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def _trie(words: list[str]):
    """The sorted words as a trie: their order, lengths and characters, which places are inside a word, and which an earlier word has too."""
    order = sorted(range(len(words)), key=words.__getitem__)
    length = np.array([len(words[k]) for k in order], np.int64)
    wide = int(length.max(initial=0))
    inside = np.arange(wide) < length[:, None]
    codes = np.zeros((len(words), wide), np.int64)
    codes[inside] = np.frombuffer("".join([words[k] for k in order]).encode("utf-32-le", "surrogatepass"), "<u4")
    same = np.zeros((len(words), wide), bool)
    same[1:] = np.logical_and.accumulate((codes[1:] == codes[:-1]) & inside[1:] & inside[:-1], axis=1)
    return order, length, codes, inside, same


class Counter:
    """Counts tokens of many pre-tokens at once; lives in a Python worker."""

    def __init__(self, pieces: list[str], scores: list[float]):
        self.pieces = pieces
        self.scores = dict(zip(pieces, scores, strict=True))
        self.floor = min(self.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.scores), default=1)
        self.counts: dict[str, int] = {}
        # A trie of the pieces read from their ends: a place of a word is reached by what ends there.
        step: dict[int, int] = {}
        score, self.piece_at = [math.nan], {}
        for number, (piece, value) in enumerate(self.scores.items()):
            node = 0
            for c in reversed(piece):
                node = step.setdefault(node << 21 | ord(c), len(score))
                if node == len(score):
                    score.append(math.nan)
            score[node] = value
            self.piece_at[node] = number
        self.step_at = Lookup(np.fromiter(step.keys(), np.int64, len(step)))
        self.step_to = np.fromiter(step.values(), np.int64, len(step))
        self.score_at = np.array(score)
        number_at = np.full(len(score), -1)
        number_at[list(self.piece_at)] = list(self.piece_at.values())
        self.piece_at = number_at

    def count(self, words: list[str]) -> list[int]:
        """Tokens of each pre-token.

        The sorted words are a trie: a prefix belongs to the first word that has
        it, and only that word's place is worked out, for all places of one depth
        together. The others take the forward score from it.
        """
        order, length, codes, inside, same = _trie(words)
        wide = codes.shape[1]
        forward = np.zeros((len(words), wide + 1))
        tokens = np.zeros((len(words), wide + 1), np.int64)
        rows = np.arange(len(words))
        for depth in range(1, wide + 1):
            first = inside[:, depth - 1] & ~same[:, depth - 1]
            own = np.flatnonzero(first)
            score, count = self._step(codes, forward, tokens, own, depth)
            forward[own, depth], tokens[own, depth] = score, count
            owner = np.maximum.accumulate(np.where(first, rows, 0))
            forward[:, depth], tokens[:, depth] = forward[owner, depth], tokens[owner, depth]
        out = np.empty(len(words), np.int64)
        out[order] = tokens[rows, length]
        return out.tolist()

    def _step(self, codes, forward, tokens, own, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Best score, and fewest tokens with it, at this depth of the words ``own``."""
        last = codes[own, depth - 1]
        size = 1 + (last >= 0x80) + (last >= 0x800) + (last >= 0x10000)
        best = forward[own, depth - 1] + size * self.floor  # as unknown bytes
        least = tokens[own, depth - 1] + size
        live, node = np.arange(len(own)), np.zeros(len(own), np.int64)
        for back in range(1, min(depth, self.longest) + 1):
            to = self.step_at(node << 21 | codes[own[live], depth - back])
            live, node = live[to >= 0], self.step_to[to[to >= 0]]
            if not len(live):
                break
            score = forward[own[live], depth - back] + self.score_at[node]
            count = tokens[own[live], depth - back] + 1
            with np.errstate(invalid="ignore"):
                better = (score > best[live]) | ((score == best[live]) & (count < least[live]))
            if back == 1:
                better = ~np.isnan(score)  # a known character is not taken apart
            best[live[better]], least[live[better]] = score[better], count[better]
        return best, least

    def expected(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, of which each occurs so many ``times``.

        ``forward`` is the logarithm of the sum over all paths to a node, ``behind``
        that of the sum over the words below it of their times, over their sums, and the paths from the node to their ends.
        """
        order, length, codes, inside, same = _trie(words)
        wide, rows = codes.shape[1], np.arange(len(words))
        forward = np.zeros((len(words), wide + 1))
        owner = np.zeros((len(words), wide + 1), np.int64)
        edges = []
        for depth in range(1, wide + 1):
            first = inside[:, depth - 1] & ~same[:, depth - 1]
            own = np.flatnonzero(first)
            owner[:, depth] = np.maximum.accumulate(np.where(first, rows, 0))
            total = np.full(len(own), -np.inf)
            live, node, known = np.arange(len(own)), np.zeros(len(own), np.int64), np.zeros(len(own), bool)
            for back in range(1, min(depth, self.longest) + 1):
                to = self.step_at(node << 21 | codes[own[live], depth - back])
                live, node = live[to >= 0], self.step_to[to[to >= 0]]
                if not len(live):
                    break
                is_piece = self.piece_at[node] >= 0
                at, piece = live[is_piece], node[is_piece]
                known[at] |= back == 1
                total[at] = np.logaddexp(total[at], forward[own[at], depth - back] + self.score_at[piece])
                edges.append((depth, back, own[at], self.piece_at[piece], self.score_at[piece]))
            last = codes[own, depth - 1]
            bytes_ = self.floor * (1 + (last >= 0x80) + (last >= 0x800) + (last >= 0x10000))
            at = np.flatnonzero(~known)
            total[at] = np.logaddexp(total[at], forward[own[at], depth - 1] + bytes_[at])
            edges.append((depth, 1, own[at], None, bytes_[at]))
            forward[own, depth] = total
            forward[:, depth] = forward[owner[:, depth], depth]
        behind = np.full((len(words), wide + 1), -np.inf)
        ends = owner[rows, length], length
        np.logaddexp.at(behind, ends, np.log(times[order]) - forward[rows, length])
        out = np.zeros(len(self.pieces))
        for depth, back, own, piece, score in reversed(edges):  # deeper nodes first
            reached = score + behind[own, depth]
            if piece is not None:
                out += np.bincount(piece, np.exp(forward[own, depth - back] + reached), len(out))
            np.logaddexp.at(behind, (owner[own, depth - back], depth - back), reached)
        return out

    def expected_long(self, word: str, times: float) -> dict[int, float]:
        """The same for one long pre-token by itself."""
        numbers = {p: k for k, p in enumerate(self.pieces)}
        edges: list[list[tuple[int, int | None, float]]] = [[]]
        for c in range(1, len(word) + 1):
            here = [(back, numbers[p], self.scores[p]) for back in range(1, min(c, self.longest) + 1) if (p := word[c - back : c]) in self.scores]
            if not any(back == 1 for back, _, _ in here):
                here.append((1, None, self.floor * len(word[c - 1].encode("utf-8", "surrogatepass"))))
            edges.append(here)
        add = lambda a, b: max(a, b) + math.log1p(math.exp(-abs(a - b))) if min(a, b) > -math.inf else max(a, b)
        forward, behind = [0.0], [-math.inf] * len(word) + [0.0]
        for c, here in enumerate(edges[1:], 1):
            total = -math.inf
            for back, _, score in here:
                total = add(total, forward[c - back] + score)
            forward.append(total)
        out: dict[int, float] = {}
        for c in range(len(word), 0, -1):
            for back, piece, score in edges[c]:
                if piece is not None:
                    share = math.exp(forward[c - back] + score + behind[c] - forward[-1])
                    out[piece] = out.get(piece, 0.0) + times * share
                behind[c - back] = add(behind[c - back], score + behind[c])
        return out

    def count_long(self, word: str) -> int:
        """The same for one long pre-token, which keeps no more than the last places."""
        window = [(0.0, 0)]
        for c in range(1, len(word) + 1):
            score, count = window[-1]
            cost = len(word[c - 1].encode("utf-8", "surrogatepass"))
            best = (score + cost * self.floor, count - cost)
            for back in range(1, min(c, self.longest) + 1):
                piece = self.scores.get(word[c - back : c])
                if piece is not None:
                    found = (window[-back][0] + piece, window[-back][1] - 1)
                    best = found if back == 1 else max(best, found)
            window.append(best)
            del window[: -self.longest - 1]
        return -window[-1][1]

    def learn(self, words: set[str]) -> None:
        unknown = list(words.difference(self.counts))
        if len(self.counts) + len(unknown) > REMEMBERED:
            self.counts.clear()
            unknown = list(words)
        # By length, so that one long word does not widen the table of all.
        short = sorted((w for w in unknown if len(w) < LONG_WORD), key=len)
        for at in range(0, len(short), AT_ONCE):
            some = short[at : at + AT_ONCE]
            self.counts.update(zip(some, self.count([BEGIN + w for w in some]), strict=True))
        for w in unknown:
            if len(w) >= LONG_WORD:
                self.counts[w] = self.count_long(BEGIN + w)

    def texts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """Words and tokens of each whole text; new words of many texts are worked out together."""
        out = [(0, 0)] * len(texts)
        waiting, chars = [], 0

        def settle() -> None:
            self.learn(set().union(*[found for _, found in waiting]))
            for k, found in waiting:
                out[k] = out[k][0] + len(found), out[k][1] + sum(map(self.counts.__getitem__, found))
            waiting.clear()

        for k, text in enumerate(texts):
            for part in _parts(text or ""):
                waiting.append((k, _WORD.findall(part)))
                chars += len(part)
                if chars >= 2 * TEXT_CHARS:
                    settle()
                    chars = 0
        settle()
        return out


def _parts(text: str):
    """A long text in parts that end between words."""
    at = 0
    while len(text) - at > TEXT_CHARS and (cut := _SPACE.search(text, at + TEXT_CHARS)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


_counters: dict[tuple, Counter] = {}


def _counter(pieces: list[str], scores: list[float]) -> Counter:
    """One counter a worker keeps."""
    key = (hash(tuple(pieces)), hash(tuple(scores)))
    if key not in _counters:
        _counters.clear()
        _counters[key] = Counter(pieces, scores)
    return _counters[key]


def scores_by_rank(pieces: list[str]) -> list[float]:
    """Where the estimation starts: a piece's chance is in proportion to one over its place in the order of use."""
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces)))) if pieces else 0.0
    return [-math.log(r + 1) - total for r in range(len(pieces))]


def _expected_of_task(pieces: list[str], scores: list[float]):
    """Adds up what the words of a task's batches are expected to hold; one row for each piece."""

    def run(batches):
        counter, out = _counter(pieces, scores), np.zeros(len(pieces))
        for batch in batches:
            words = batch.column(0).to_pylist()
            times = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            short = sorted((k for k, w in enumerate(words) if len(w) < LONG_WORD), key=lambda k: len(words[k]))
            for at in range(0, len(short), AT_ONCE):
                some = short[at : at + AT_ONCE]
                out += counter.expected([BEGIN + words[k] for k in some], times[some])
            for k, w in enumerate(words):
                if len(w) >= LONG_WORD:
                    for piece, n in counter.expected_long(BEGIN + w, times[k]).items():
                        out[piece] += n
        seen = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(out[seen])], names=["piece", "n"])

    return run


def estimate_scores(docs: DataFrame, pieces: list[str], text: str = "text", rounds: int = ROUNDS) -> list[float]:
    """Scores of the pieces, by expectation-maximisation over the words of all documents.

    The words are counted once and written. Sums come in no certain order, so scores are rounded to nine digits.
    """
    split = F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), r"[\x20\x09-\x0D]+")
    words = docs.select(F.explode(split).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    words = materialize(words, "words")
    scores = scores_by_rank(pieces)
    for _ in range(rounds if pieces else 0):
        found = words.mapInArrow(portable(_expected_of_task(pieces, scores)), "piece long, n double")
        seen = np.full(len(pieces), UNSEEN)
        for row in found.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            seen[row.piece] += row.n
        scores = np.round(np.log(seen / seen.sum()), 9).tolist()
    return scores


def count_tokens(docs: DataFrame, pieces: list[str], text: str = "text", scores: list[float] | None = None) -> DataFrame:
    """Add ``n_words`` and ``n_tokens`` of each whole text; without ``scores`` they are estimated from these texts."""
    chosen = estimate_scores(docs, pieces, text) if scores is None else scores

    def prepare():
        counter = _counter(pieces, chosen)

        def compute(texts):
            gc.disable()  # millions of words are listed, none of them in cycles
            try:
                found = counter.texts(texts.to_pylist())
            finally:
                gc.enable()
            return [[w for w, _ in found], [n for _, n in found]]

        return compute

    return append_columns(docs, [text], OUTPUT, prepare)
