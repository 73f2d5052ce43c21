"""Periodic runs of words, by a dictionary of basic factors.

For every power of two ``m`` the dictionary names the factors of ``m`` words: two
places have the same name if the same words follow. The names of ``2 m`` words
are those of the pairs of names ``m`` places apart. Only places whose factor
occurs again are kept, so in ordinary prose few are left after a level or two.

A run of smallest period ``q``, ``m <= q < 2 m``, repeats the factor at its first
place ``q`` words later, that is within twice the factor's length. There the
occurrences of one factor form few arithmetic progressions: neighbours at most
``m / 2`` apart have one common difference, and progressions begin more than
``m / 2`` apart. A run cannot be lengthened to the left, so its first place or
the one a period later begins a progression. That leaves, for each place, the
next three beginnings behind it and the last three before it; their distances
are the proposed periods. Two more names tell whether a whole period is repeated
(a square), the run is extended to the right, and of several periods of one
stretch the smallest is kept.

Work is in proportion to the words times the logarithm of their number, also for
texts that repeat a single word.

Defined cases: null and empty texts have no words, no runs and the collapsed text
``""``; equal texts get equal results; texts of any length are taken whole; an empty
table gives an empty result; output columns replace input columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T

from workledger.llm.common import append_columns

LEAST_WORDS = 12
WORDS_AT_ONCE = 1 << 18

RUNS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")]))
OUTPUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])

# A factor occurs in at most this many further progressions within twice its length.
_FURTHER = 3


def _level(key: np.ndarray, place: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places whose key occurs again, sorted by name and place, with their names; and the name at every place, -1 for the others."""
    order = np.argsort(key, kind="stable")
    key, place = key[order], place[order]
    number = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    again = np.bincount(number)[number] > 1
    place, number = place[again], number[again]
    name = np.full(size, -1, np.int64)
    name[place] = number
    return place, number, name


def _proposals(place: np.ndarray, number: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of places (first place of a run, period) that this level proposes."""
    same = number[1:] == number[:-1]
    begins = np.concatenate([[True], ~(same & (2 * (place[1:] - place[:-1]) <= m))])
    progression = np.cumsum(begins) - 1
    first = place[begins]
    name_of = number[begins]
    firsts, periods = [], []

    def propose(begin: np.ndarray, later: np.ndarray) -> None:
        distance = later - begin
        right = (distance >= m) & (distance < 2 * m)
        firsts.append(begin[right])
        periods.append(distance[right])

    for further in range(1, _FURTHER + 1):
        other = progression + further
        there = np.flatnonzero(other < len(first))
        there = there[name_of[other[there]] == number[there]]
        propose(place[there], first[other[there]])
        other = progression - further
        there = np.flatnonzero(other >= 0)
        there = there[name_of[other[there]] == number[there]]
        propose(first[other[there]], place[there])
    return np.concatenate(firsts), np.concatenate(periods)


def _end(words: np.ndarray, at: int, period: int) -> int:
    """Where the equality with the word ``period`` places before ends, from ``at`` on."""
    step = 64
    while True:
        own = words[at : at + step]
        differ = np.flatnonzero(own != words[at - period : at - period + len(own)])
        if len(differ):
            return at + int(differ[0])
        if len(own) < step:
            return at + len(own)
        at, step = at + step, step * 2


def find_runs(words: np.ndarray, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run in an array of word numbers, by start and then period.

    A run has at least ``least`` words and twice its period. Texts may stand one
    behind the other if they have no word number in common.
    """
    size = len(words)
    found: dict[tuple[int, int], int] = {}
    if size < 2:
        return []
    # One word in front and some behind that equal no other.
    padded = np.concatenate([[-1], words, np.full(least + 2, -2)])
    word = padded[1:]
    place, number, name = _level(words, np.arange(size), size)
    m = 1
    while len(place):
        begin, period = _proposals(place, number, m)
        left = np.flatnonzero(padded[begin] != padded[begin + period])
        begin, period = begin[left], period[left]
        last = begin + 2 * period - m
        inside = np.flatnonzero(last < size)
        begin, period, last = begin[inside], period[inside], last[inside]
        square = np.flatnonzero((name[last] >= 0) & (name[last] == name[last - period]))
        begin, period = begin[square], period[square]
        for offset in range(m, least - m):  # only short periods have too short squares
            short = (period <= offset) & (offset < least - period)
            holds = ~short | (word[np.minimum(begin + offset, size)] == word[np.minimum(begin + period + offset, size + 1)])
            begin, period = begin[holds], period[holds]
        order = np.argsort(period, kind="stable")
        for b, p in zip(begin[order].tolist(), period[order].tolist(), strict=True):
            end = _end(words, b + 2 * p, p)
            if end - b >= least:
                found.setdefault((b, end), p)
        if 2 * m > size:
            break
        more = place[place + m < size]
        more = np.sort(more[name[more + m] >= 0])
        if not len(more):
            break
        place, number, name = _level(name[more] * size + name[more + m], more, size)
        m *= 2
    return sorted((b, end - b, p) for (b, end), p in found.items())


def collapse(texts: list[bytes], least: int = LEAST_WORDS) -> list[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Per text the number of words, its runs, and the text without the repetitions."""
    split = [t.split() for t in texts]
    sizes = np.array([len(words) for words in split])
    flat = np.empty(int(sizes.sum()), object)
    flat[:] = [w for words in split for w in words]
    codes, distinct = pd.factorize(flat)
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    runs = find_runs(codes + owner * max(1, len(distinct)), least)
    begin = np.array([r[0] for r in runs], np.int64)
    cut = np.searchsorted(begin, np.concatenate([[0], ends]))
    out = []
    for k, words in enumerate(split):
        shift = int(ends[k] - sizes[k])
        own = [(b - shift, length, p) for b, length, p in runs[cut[k] : cut[k + 1]]]
        if not own:
            out.append((len(words), [], b" ".join(words)))
            continue
        change = np.zeros(len(words) + 1, np.int64)
        for b, length, p in own:
            change[b + p] += 1
            change[b + length] -= 1
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        out.append((len(words), own, b" ".join([words[i] for i in kept.tolist()])))
    return out


def periodic_runs(docs: DataFrame, text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """Add ``n_words``, ``runs`` (start, length and period in words) and ``collapsed``.

    ``collapsed`` holds the words, joined by a space, that no run contains after
    that run's first period.
    """

    def prepare():
        def compute(texts):
            out, waiting, size = [], [], 0
            for t in texts:
                waiting.append((t.as_py() or "").encode("utf-8", "surrogatepass"))
                size += len(waiting[-1]) // 6
                if size >= WORDS_AT_ONCE:
                    out += collapse(waiting, least)
                    waiting, size = [], 0
            if waiting:
                out += collapse(waiting, least)
            names = ("start", "length", "period")
            return [
                [n for n, _, _ in out],
                [[dict(zip(names, run, strict=True)) for run in runs] for _, runs, _ in out],
                [c.decode("utf-8", "surrogatepass") for _, _, c in out],
            ]

        return compute

    return append_columns(docs, [text], OUTPUT, prepare)
