"""Byte-level BPE: propose tokens greedily, verify neighbours, merge only what fails.

A sequence of tokens is what ranked merging makes of a word exactly if every
token survives merging alone and no merge crosses the border of two neighbours.
So the longest-match proposal of each distinct word is tested pair by pair, in
arrays, and only words with a failing pair go through the merges themselves.

Defined cases: null text gives no tokens, like the empty text; null ids decode to the
empty text; equal rows give equal results; texts of any length are coded whole; an
empty table gives an empty result; input columns named like an output
(``ids``, ``decoded``) are replaced.
"""

from __future__ import annotations

import gc
import heapq
import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

from workledger.llm.common import Lookup, append_columns

# The pre-token pattern of the public vocabulary, and Unicode's white space.
PRETOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# A border between text and white space is always a border of pre-tokens.
_CUT = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")
_PRETOKEN = regex.compile(
    PRETOKEN.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")
)

PIECE_CHARS = 1 << 18
REMEMBERED = 120_000
PAIRS = 60_000
LONG_WORD = 128
AT_ONCE = 1 << 14
NEVER = np.int64(1) << 40


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """Tokens, merges and special strings of a tokenizer file, as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        letters = _byte_letters()
        vocab = parsed["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.tokens[i] = bytes(letters[c] for c in token)
        for content, i in self.special.items():
            self.tokens[i] = content.encode()
        self.left = np.full(size, -1, np.int64)
        self.right = np.full(size, -1, np.int64)
        self.rank = np.full(size, -1, np.int64)
        for rank, merge in enumerate(parsed["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocab[a + b]
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = vocab[a], vocab[b], rank


class Encoder:
    """Encodes words of one vocabulary; lives in a Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.size = len(v.tokens)
        made = np.flatnonzero(v.rank >= 0)
        self.made = made
        self.pair_at = Lookup(v.left[made] * self.size + v.right[made])
        self.byte_token = np.full(256, -1, np.int64)
        ordinary = set(range(self.size)) - set(v.special.values())
        for i in ordinary:
            if len(v.tokens[i]) == 1:
                self.byte_token[v.tokens[i][0]] = i
        self._grow_trie(ordinary)
        self.up_right, self.right_length = self._spine(v.right)
        self.up_left, self.left_length = self._spine(v.left)
        self.merge_made = np.full(int(v.rank.max(initial=0)) + 1, -1)
        self.merge_made[v.rank[made]] = made
        self.proper = np.ones(self.size, bool)
        self.proper[made] = self.first_crossing(v.left[made], v.right[made]) == v.rank[made]
        self.pairs: dict[int, bool] = {}
        self.merge_of = {(int(v.left[i]), int(v.right[i])): (int(v.rank[i]), int(i)) for i in made}
        self.words: dict[str, bytes] = {}

    def _grow_trie(self, ordinary: set[int]) -> None:
        """Transitions of the trie of all tokens; the token that ends at a node, or -1."""
        step: dict[int, int] = {}
        ends = [-1]
        for i in ordinary:
            node = 0
            for byte in self.vocabulary.tokens[i]:
                node = step.setdefault(node << 8 | byte, len(ends))
                if node == len(ends):
                    ends.append(-1)
            if node:
                ends[node] = i
        self.step, self.ends = step, np.array(ends)
        self.step_at = Lookup(np.fromiter(step.keys(), np.int64, len(step)))
        self.step_to = np.fromiter(step.values(), np.int64, len(step))

    def _spine(self, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per token its chain of edge parts, from the single byte up to the token itself."""
        chain = [np.arange(self.size)]
        while (chain[-1] >= 0).any():
            below = chain[-1]
            chain.append(np.where(below >= 0, child[below], -1))
        table = np.stack(chain[:-1], 1)
        length = (table >= 0).sum(1)
        at = length[:, None] - 1 - np.arange(table.shape[1])
        return np.where(at >= 0, np.take_along_axis(table, np.maximum(at, 0), 1), -1).astype(np.int32), length

    def _merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.pair_at(a.astype(np.int64) * self.size + b)
        return np.where(at >= 0, self.vocabulary.rank[self.made[at]], NEVER)

    def first_crossing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the first merge over the border of each pair, NEVER if there is none.

        Both sides grow along their edge parts in order of rank. A border merge
        comes first if it ranks before the left side's next step, and not after
        the right side's: of equal merges the leftmost one is made first.
        """
        found = np.full(len(left), NEVER)
        i, j = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        open_ = np.arange(len(left))
        rank = self.vocabulary.rank
        while len(open_):
            l, r, a, b = left[open_], right[open_], i[open_], j[open_]
            crossing = self._merge_rank(self.up_right[l, a], self.up_left[r, b])
            more_l, more_r = a + 1 < self.right_length[l], b + 1 < self.left_length[r]
            next_l = np.where(more_l, rank[self.up_right[l, np.minimum(a + 1, self.up_right.shape[1] - 1)]], NEVER)
            next_r = np.where(more_r, rank[self.up_left[r, np.minimum(b + 1, self.up_left.shape[1] - 1)]], NEVER)
            crosses = (crossing < NEVER) & (crossing < next_l) & (crossing <= next_r)
            found[open_[crosses]] = crossing[crosses]
            grow_l = more_l & (next_l <= next_r)
            i[open_] += grow_l
            j[open_] += more_r & ~grow_l
            open_ = open_[~crosses & (more_l | more_r)]
        return found

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of all words, walking the trie for all at once: (word, token) in order."""
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        stop = np.cumsum([len(w) for w in words])
        place = stop - [len(w) for w in words]
        of, token, nth = [], [], []
        live, turn = np.flatnonzero(place < stop), 0
        while len(live):
            best = np.full(len(live), -1)
            length = np.zeros(len(live), np.int64)
            walk, node, depth = np.arange(len(live)), np.zeros(len(live), np.int64), 0
            while len(walk):
                at = place[live[walk]] + depth
                inside = at < stop[live[walk]]
                walk, node, at = walk[inside], node[inside], at[inside]
                to = self.step_at(node << 8 | text[at])
                goes = to >= 0
                walk, node = walk[goes], self.step_to[to[goes]]
                depth += 1
                ends = self.ends[node]
                hit = ends >= 0
                best[walk[hit]], length[walk[hit]] = ends[hit], depth
            of.append(live)
            token.append(best)
            nth.append(np.full(len(live), turn))
            place[live] += length
            live, turn = live[place[live] < stop[live]], turn + 1
        if not of:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        of_all, token_all = np.concatenate(of), np.concatenate(token)
        order = np.lexsort((np.concatenate(nth), of_all))
        return of_all[order], token_all[order]

    def propose_long(self, word: bytes) -> list[int]:
        """The same for one long word."""
        out, at = [], 0
        while at < len(word):
            node, depth, best, length = 0, at, -1, 0
            while depth < len(word) and (node := self.step.get(node << 8 | word[depth], 0)):
                depth += 1
                if self.ends[node] >= 0:
                    best, length = int(self.ends[node]), depth - at
            out.append(best)
            at += length
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of neighbours as it is; every pair is worked out once."""
        keys, back = np.unique(left * self.size + right, return_inverse=True)
        listed = keys.tolist()
        new = np.array([k for k in listed if k not in self.pairs], np.int64)
        if len(new):
            if len(self.pairs) + len(new) > PAIRS:
                self.pairs.clear()
                new = keys
            good = self.first_crossing(new // self.size, new % self.size) == NEVER
            self.pairs.update(zip(new.tolist(), good.tolist(), strict=True))
        return np.array([self.pairs[k] for k in listed], bool)[back]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging, lowest rank first and leftmost among equals; one merge of every word per turn.

        Returns all tokens in order and their number per word.
        """
        n, length = len(words), np.array([len(w) for w in words])
        wide = int(length.max()) + 1
        column = np.arange(wide)
        inside = column < length[:, None]
        ids = np.full((n, wide), -1, np.int64)
        ids[inside] = self.byte_token[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((n, wide), NEVER)
        pair = inside[:, 1:]
        ranks[:, :-1][pair] = self._merge_rank(ids[:, :-1][pair], ids[:, 1:][pair])
        live = np.arange(n)
        while True:
            at = ranks[live].argmin(1)
            can = ranks[live, at] < NEVER
            live, at = live[can], at[can]
            if not len(live):
                return ids[ids >= 0], (ids >= 0).sum(1)
            merged = self.merge_made[ranks[live, at]]
            # Close the gap: what is right of the merged pair moves one place left.
            source = np.minimum(column + (column > at[:, None]), wide - 1)
            ids[live] = np.take_along_axis(ids[live], source, 1)
            ranks[live] = np.take_along_axis(ranks[live], source, 1)
            ids[live, at] = merged
            for place in (at - 1, at):
                known = (place >= 0) & (ids[live, place + 1] >= 0)
                ranks[live[place >= 0], place[place >= 0]] = NEVER
                row, col = live[known], place[known]
                ranks[row, col] = self._merge_rank(ids[row, col], ids[row, col + 1])

    def merge_long(self, word: bytes) -> list[int]:
        """The same for one long word."""
        ids = self.byte_token[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        queue = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(ids) and (found := self.merge_of.get((ids[at], ids[after[at]]))):
                heapq.heappush(queue, (found[0], at, ids[at], ids[after[at]], found[1]))

        for at in range(len(ids) - 1):
            offer(at)
        while queue:
            _, at, a, b, made = heapq.heappop(queue)
            if ids[at] != a or after[at] >= len(ids) or ids[after[at]] != b:
                continue
            gone = after[at]
            ids[at], ids[gone], after[at] = made, -1, after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [i for i in ids if i >= 0]

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, as 32-bit integers."""
        out: list[bytes] = [b""] * len(words)

        def put(which: list[int], token: np.ndarray, count: np.ndarray) -> None:
            ids, stop = token.astype("<i4").tobytes(), (4 * np.cumsum(count)).tolist()
            begin = 0
            for k, end in zip(which, stop, strict=True):
                out[k] = ids[begin:end]
                begin = end

        lengths = np.array([len(w) for w in words])
        short = np.flatnonzero(lengths <= LONG_WORD)
        again = []
        for at in range(0, len(short), AT_ONCE):
            some = short[at : at + AT_ONCE]
            of, token = self.propose([words[k] for k in some])
            count = np.bincount(of, minlength=len(some))
            put(some.tolist(), token, count)
            again.append(some[self._fails(of, token, len(some))])
        failing = np.concatenate([*again, np.zeros(0, np.int64)]).astype(np.int64)
        failing = failing[np.argsort(lengths[failing], kind="stable")]
        for at in range(0, len(failing), AT_ONCE):
            some = failing[at : at + AT_ONCE].tolist()
            put(some, *self.merge([words[k] for k in some]))
        for k in np.flatnonzero(lengths > LONG_WORD).tolist():
            token = np.array(self.propose_long(words[k]))
            if self._fails(np.zeros(len(token), np.int64), token, 1)[0]:
                token = np.array(self.merge_long(words[k]))
            put([k], token, np.array([len(token)]))
        return out

    def _fails(self, of: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
        """Which of ``n`` words hold a token or a pair of neighbours that merging would not leave so."""
        fails = np.zeros(n, bool)
        fails[of[(token < 0) | ~self.proper[token]]] = True
        at = np.flatnonzero((of[:-1] == of[1:]) & ~fails[of[:-1]])
        if len(at):
            fails[of[at[~self.compatible(token[at], token[at + 1])]]] = True
        return fails

    def learn(self, words: set[str]) -> None:
        """Remember the ids of these words."""
        unknown = list(words.difference(self.words))
        if len(self.words) + len(unknown) > REMEMBERED:
            self.words.clear()
            unknown = list(words)
        self.words.update(zip(unknown, self.encode_words([w.encode() for w in unknown]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers; new words of many texts are worked out together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        chars = 0

        def settle() -> None:
            self.learn(set().union(*[words for _, words in waiting]))
            for k, words in waiting:
                out[k].append(b"".join(map(self.words.__getitem__, words)))
            waiting.clear()

        for k, text in enumerate(texts):
            for nth, part in enumerate(self.special_split(text)):
                if nth % 2:
                    settle()
                    out[k].append(np.int32(self.vocabulary.special[part]).tobytes())
                    continue
                for piece in pieces(part):
                    waiting.append((k, _PRETOKEN.findall(piece)))
                    chars += len(piece)
                    if chars >= 2 * PIECE_CHARS:
                        settle()
                        chars = 0
        settle()
        return [b"".join(parts) for parts in out]

    def special_split(self, text: str) -> list[str]:
        """Ordinary text at even places, special strings at odd ones."""
        names = sorted(self.vocabulary.special, key=len, reverse=True)
        if not any(name in text for name in names):
            return [text]
        return re.split("(" + "|".join(map(re.escape, names)) + ")", text)


def pieces(text: str, size: int = PIECE_CHARS):
    """Parts of about ``size`` characters that can be encoded one by one."""
    at = 0
    while len(text) - at > size and (cut := _CUT.search(text, at + size)):
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:] if at else text


_encoders: dict[int, Encoder] = {}


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """One encoder per worker process, whatever number of tasks it runs."""
    key = hash((len(vocabulary.tokens), tuple(vocabulary.tokens[-2000:]), tuple(vocabulary.special.items())))
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def _encoded(encoder: Encoder, texts: list[str | None]) -> pa.ListArray:
    gc.disable()  # many words are listed, none of them in cycles
    try:
        ids = encoder.encode([t or "" for t in texts])
    finally:
        gc.enable()
    offsets = np.cumsum([0, *[len(x) // 4 for x in ids]]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        self.joined = np.frombuffer(b"".join(vocabulary.tokens), np.uint8)
        self.length = np.array([len(t) for t in vocabulary.tokens])
        self.start = np.cumsum(self.length) - self.length

    def text(self, ids: pa.ListScalar) -> str:
        if not ids.is_valid:
            return ""
        tokens, parts = ids.values.to_numpy(zero_copy_only=False), []
        for at in range(0, len(tokens), PIECE_CHARS):
            some = tokens[at : at + PIECE_CHARS]
            n = self.length[some]
            place = np.repeat(self.start[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            parts.append(self.joined[place].tobytes())
        return b"".join(parts).decode("utf-8", "replace")


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), True))
_DECODED = T.StructField("decoded", T.StringType())


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Add ``ids``, the token ids of each whole text."""

    def prepare():
        encoder = _encoder(vocabulary)
        return lambda texts: [_encoded(encoder, texts.to_pylist())]

    return append_columns(docs, [text], T.StructType([_IDS]), prepare)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the token ids; bytes that are no UTF-8 become U+FFFD."""

    def prepare():
        decoder = Decoder(vocabulary)
        return lambda lists: [[decoder.text(x) for x in lists]]

    return append_columns(docs, [ids], T.StructType([_DECODED]), prepare)


def encode_and_decode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """Add ``ids`` and, from these, ``decoded``, in one worker."""

    def prepare():
        encoder, decoder = _encoder(vocabulary), Decoder(vocabulary)

        def compute(texts):
            ids = _encoded(encoder, texts.to_pylist())
            return [ids, [decoder.text(x) for x in ids]]

        return compute

    return append_columns(docs, [text], T.StructType([_IDS, _DECODED]), prepare)
