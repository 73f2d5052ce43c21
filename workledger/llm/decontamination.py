"""Benchmark decontamination: one scan of each text by an Aho-Corasick automaton.

The patterns are the windows of 13 consecutive words of the normalised test
questions and answers (a shorter item is one window). The automaton's letters are the words of the
normalised text, so a window matches at word
borders only, and every match leads back to the characters of the original text.

The items are a stated query set, and up to ``BLOCK_CHARS`` characters of them are one automaton in
compact arrays: one job scans every text once. Only larger benchmarks are taken in blocks of
that size, each an automaton and a job of its own, which writes the findings
of documents with hits; one aggregation puts them together.

Defined cases: null and empty texts have no words, no hits and are clean;
items without text, without id (unless they are asked for) and items without words match nothing; equal items are all reported;
an empty benchmark leaves every document clean; texts of any length are scanned
whole and equal rows give equal results. Output columns replace input
columns of the same names.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from workledger.llm.common import append_columns
from workledger.session import fresh_folder, materialize

WINDOW = 13
# A state takes 14 bytes, a word makes WINDOW states at most and takes two characters at
# least: an automaton takes less than 100 bytes for each character of its items, and about 30 for prose.
BLOCK_CHARS = 12_000_000
LANE = 64

# Upper case becomes lower case and every ASCII byte that is no word byte a space.
_NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_words", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hits", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    ]
)


Findings = tuple[int, list[int], list[str | None], list[tuple[int, int]]]


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_NORMAL).split() if text else []


class Automaton:
    """All windows of a block of items in one Aho-Corasick automaton whose letters are words.

    States are numbered by depth and then by path, so the children of a state
    stand together, ordered by word. Arrays hold for each state where its children begin, the
    word that leads to it, the longest other path that ends alike, and whether windows end.
    """

    def __init__(self, items: list[tuple[str | None, str]]):
        self.names = [name for name, _ in items]
        number: dict[bytes, int] = {}
        ids = [np.array([number.setdefault(w, len(number)) for w in words_of(text)], np.int32) for _, text in items]
        self.vocabulary = list(number)
        windows, owners = self._windows(ids)
        # Windows in order of their words; of the rows of one window the first one stands for it.
        order = np.lexsort((owners, *windows.T[::-1]))
        windows, owners = windows[order], owners[order]
        alike = np.zeros(len(windows), np.int8)  # leading words shared with the row before
        same = np.ones(len(windows), bool)
        same[:1] = False
        for column in range(WINDOW):
            same[1:] &= windows[1:, column] == windows[:-1, column]
            alike += same
        first_rows = np.flatnonzero(alike < WINDOW)
        ends = self._states(windows[first_rows], alike[first_rows])
        again = np.zeros(len(owners), bool)
        again[1:] = (alike[1:] == WINDOW) & (owners[1:] == owners[:-1])
        window = np.cumsum(alike < WINDOW)[~again] - 1
        self.owners = owners[~again][np.argsort(ends[window], kind="stable")]
        self.ends, counts = np.unique(ends[window], return_counts=True)
        self.owned = np.concatenate([[0], np.cumsum(counts)])

    @staticmethod
    def _windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of word numbers, short items filled up with -1, and the item of each row."""
        sizes = np.array([len(i) for i in ids], np.int64)
        fill = np.full(WINDOW, -1, np.int32)
        words = np.concatenate([*ids, fill])
        begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if ids else sizes
        count = np.where(sizes > 0, np.maximum(sizes - WINDOW, 0) + 1, 0)
        owners = np.repeat(np.arange(len(ids), dtype=np.int32), count)
        start = np.arange(len(owners)) - np.repeat(np.cumsum(count) - count, count) + begin[owners]
        rows = words[start[:, None] + np.arange(WINDOW)]
        rows[np.arange(WINDOW) >= sizes[owners][:, None]] = -1
        return rows, owners

    def _states(self, windows: np.ndarray, alike: np.ndarray) -> np.ndarray:
        """Make the states; returned is the state behind each window."""
        lengths = (windows >= 0).sum(1)
        self.least = int(lengths.min(initial=WINDOW))
        label, parent, depths = [np.full(1, -1, np.int32)], [np.zeros(1, np.int32)], [0]
        above, ends, size = np.zeros(len(windows), np.int32), np.zeros(len(windows), np.int32), 1
        for depth in range(1, WINDOW + 1):
            new = (alike < depth) & (lengths >= depth)
            label.append(windows[new, depth - 1])
            parent.append(above[new])
            above = (size - 1 + np.cumsum(new)).astype(np.int32)
            ends[lengths == depth] = above[lengths == depth]
            size += int(new.sum())
            depths.append(size)
        self.label = np.concatenate(label)
        up = np.concatenate(parent)
        self.first = (1 + np.searchsorted(up[1:], np.arange(size + 1))).astype(np.int32)
        self.root = np.zeros(len(self.vocabulary) + 1, np.int32)  # the last entry is that of unknown words
        self.root[self.label[1 : self.first[1]]] = np.arange(1, self.first[1])
        self.length = np.zeros(size, np.int8)
        self.length[ends] = lengths
        self.reports = self.length > 0
        self.fail = np.zeros(size, np.int32)
        for begin, end in itertools.pairwise(depths[1:]):
            self.fail[begin:end] = self._step(self.fail[up[begin:end]], self.label[begin:end])
            self.reports[begin:end] |= self.reports[self.fail[begin:end]]
        return ends

    def nbytes(self) -> int:
        return sum(x.nbytes for x in vars(self).values() if isinstance(x, np.ndarray))

    def _child(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The states behind one word more, 0 where there is none."""
        low, end = self.first[state], self.first[state + 1]
        high = end.copy()
        while len(at := np.flatnonzero(low < high)):
            middle = low[at] + (high[at] - low[at]) // 2
            less = self.label[middle] < word[at]
            low[at[less]] = middle[less] + 1
            high[at[~less]] = middle[~less]
        there = low < end
        there[there] = self.label[low[there]] == word[there]
        return np.where(there, low, 0)

    def _step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Every state after its next word."""
        out = self.root[word]
        at = np.flatnonzero((state > 0) & (word >= 0))
        state = state[at]
        while len(at):
            child = self._child(state, word[at])
            out[at[child > 0]] = child[child > 0]
            state = self.fail[state]
            on = (child == 0) & (state > 0)  # at the root the word alone decides
            at, state = at[on], state[on]
        return out

    def _run(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and states of one pass over word numbers, where windows end.

        The pass goes along many lanes at once. Each first reads the words before it that a state can depend on.
        """
        before = WINDOW - 1
        lanes = -(-len(words) // LANE)
        padded = np.full(before + lanes * LANE, -1, np.int32)
        padded[before : before + len(words)] = words
        columns = np.lib.stride_tricks.sliding_window_view(padded, before + LANE)[::LANE].T
        state, places, states = np.zeros(lanes, np.int32), [], []
        for n, column in enumerate(columns):
            state = self._step(state, column)
            if n >= before and len(at := np.flatnonzero(self.reports[state])):
                places.append(at * LANE + n - before)
                states.append(state[at])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(places), np.concatenate(states)

    def _matches(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the last word, and state, of every window that occurs, by place."""
        # Only runs of known words that are long enough for a window are read.
        edge = np.diff(np.concatenate([[0], (words >= 0).view(np.int8), [0]]))
        begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        enough = stop - begin >= self.least
        begin, size = begin[enough], (stop - begin)[enough] + 1  # with the unknown word behind
        if not len(size):
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        origin = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
        place, state = self._run(words[origin])
        place, places, states = origin[place], [origin[:0]], [state[:0]]
        while len(state):
            full = self.length[state] > 0
            places.append(place[full])
            states.append(state[full])
            state = self.fail[state]
            place, state = place[self.reports[state]], state[self.reports[state]]
        place, state = np.concatenate(places), np.concatenate(states)
        order = np.argsort(place, kind="stable")
        return place[order], state[order]

    def scan_all(self, texts: list[str | None]) -> list[Findings]:
        """For each text what ``scan`` returns; all of them are read in one pass."""
        if not hasattr(self, "number"):
            self.number = {w: n for n, w in enumerate(self.vocabulary)}
        parts, sizes = [], []
        for text in texts:
            words = words_of(text)
            sizes.append(len(words))
            parts.append(np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int32, len(words)))
            parts.append(np.full(1, -1, np.int32))
        out: list[Findings] = [(n, [], [], []) for n in sizes]
        if not parts:
            return out
        begin = np.cumsum(np.array(sizes) + 1) - np.array(sizes) - 1
        place, state = self._matches(np.concatenate(parts))
        of = np.searchsorted(begin, place, side="right") - 1
        texts_hit, first = np.unique(of, return_index=True)
        for n, a, b in zip(texts_hit.tolist(), first, np.append(first, len(of))[1:], strict=True):
            last, ends = place[a:b] - begin[n], state[a:b]
            spans = _joined(list(zip((last - self.length[ends] + 1).tolist(), last.tolist(), strict=True)))
            rank = np.searchsorted(self.ends, np.unique(ends))
            owners = np.concatenate([self.owners[self.owned[r] : self.owned[r + 1]] for r in rank])
            found = {self.names[i] for i in np.unique(owners).tolist()}
            hit_words = [w for x, y in spans for w in range(x, y + 1)]
            out[n] = (sizes[n], hit_words, sorted(found, key=lambda name: name or ""), _offsets(texts[n], spans))
        return out

    def scan(self, text: str | None) -> Findings:
        """Word count, places of hit words, ids of items found, and hit passages as character offsets."""
        return self.scan_all([text])[0]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character ranges of the original text, end exclusive."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    inside = np.frombuffer(raw.translate(_NORMAL), np.uint8) != 32
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    char = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters before each byte
    return [(int(char[begin[a]]), int(char[stop[b]])) for a, b in spans]


def item_blocks(items: DataFrame, id_column: str = "item_id", text_column: str = "text", unnamed: bool = False):
    """The items in blocks of less than ``BLOCK_CHARS`` characters besides one item, received one block at a time.

    The numbered blocks are written to the shared folder. A block's items may come of several partitions.
    """
    named = items.select(F.col(id_column).cast("string").alias("name"), F.col(text_column).alias("text"))
    named = named.dropna(subset=["text"] if unnamed else None)
    # Written first, as the part a row is met in may differ between two readings.
    placed = named.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    placed = materialize(placed, "items")
    size, offsets = 0, []
    for row in placed.groupBy("part").agg(F.sum(F.length("text")).alias("size")).sort("part").collect():
        offsets.append((row.part, size))
        size += row.size
    before = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.col("offset") + F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))
    parts = items.sparkSession.createDataFrame(offsets, "part int, offset long")
    numbered = placed.join(F.broadcast(parts), "part").withColumn("block", F.floor(begin / BLOCK_CHARS))
    blocks = materialize(numbered, "blocks")
    for number in range(size // BLOCK_CHARS + 1 if offsets else 0):
        own = [(item.name, item.text) for item in blocks.filter(F.col("block") == number).sort("place").collect()]
        if own:
            yield own


def scan(docs: DataFrame, items: list[tuple[str | None, str]], text: str = "text", output: str = "found") -> DataFrame:
    """Add the struct ``output``: findings of one block of items in each whole text.

    The automaton is made once and broadcast; the block's characters bound its size.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(items))

    def prepare(automaton):
        def compute(texts):
            rows = automaton.scan_all(texts.to_pylist())
            return [[dict(zip(FOUND.fieldNames(), (n, w, i, [{"start": a, "end": b} for a, b in s]), strict=True)) for n, w, i, s in rows]]

        return compute

    return append_columns(docs, [text], T.StructType([T.StructField(output, FOUND)]), prepare, shared)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", unnamed: bool = False) -> DataFrame:
    """Add ``n_words, n_hit, n_items, items, hits, contaminated`` to every document.

    ``items`` holds the ids found, sorted as strings; ``hits`` the hit passages of
    the original text (those of different blocks may overlap). A document is
    contaminated if at least a twentieth of its words, and at least one, is hit.
    With ``unnamed``, items without id count too, as the SQL has them: together
    they are one item whose id is null. Otherwise they match nothing.
    """
    made = ["n_words", "n_hit", "n_items", "items", "hits", "contaminated"]
    blocks = item_blocks(benchmark, unnamed=unnamed)
    first, second = next(blocks, []), next(blocks, None)
    # Columns go by place meanwhile, so that no name of theirs clashes.
    held = docs.toDF(*[f"c{n}" for n in range(len(docs.columns))])
    text = next(h for h, c in zip(held.columns, docs.columns, strict=True) if c.lower() == text.lower())
    if second is None:
        fields = ["__found.hit_words", "__found.items", "__found.hits"]
        out = scan(held, first, text, "__found")
    else:
        rows = materialize(held.withColumn("__place", F.monotonically_increasing_id()), "documents")
        path = fresh_folder(docs.sparkSession, "found")
        # A job for each block, so that a task holds one automaton; only documents with hits are written.
        for block in itertools.chain([second], blocks):
            found = scan(rows.select("__place", F.col(text).alias("__text")), block, "__text", "__found")
            found.filter(F.size("__found.hits") > 0).select("__place", "__found").write.mode("append").parquet(path)
        fields = ["hit_words", "items", "hits"]
        others = docs.sparkSession.read.schema(T.StructType([T.StructField("__place", T.LongType()), T.StructField("__found", FOUND)])).parquet(path)
        others = others.groupBy("__place").agg(*[F.flatten(F.collect_list(f"__found.{f}")).alias(f"__{f}") for f in fields])
        both = lambda f: F.concat(f"__found.{f}", F.coalesce(f"__{f}", F.array())).alias(f"__all_{f}")
        out = scan(rows, first, text, "__found").join(others, "__place", "left")
        out = out.select(*held.columns, "__found", *[both(f) for f in fields])
        fields = [f"__all_{f}" for f in fields]
    hit_words, items, hits = fields
    out = out.select(
        *[F.col(h).alias(c) for h, c in zip(held.columns, docs.columns, strict=True) if c.lower() not in made],
        F.col("__found.n_words").alias("n_words"),
        F.size(F.array_distinct(hit_words)).cast("long").alias("n_hit"),
        F.sort_array(F.array_distinct(items)).alias("items"),
        F.sort_array(hits).alias("hits"),
    )
    return out.withColumns(
        {
            "n_items": F.size("items").cast("long"),
            "contaminated": (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")),
        }
    )
