"""Language ID by string kernels.

The kernel of two texts is the number of n-grams (a blended spectrum of one to
three letters, each counted once, of those that some landmark has) that both
have, over the root of the product of their numbers. Landmark texts give Nyström features, and kernel ridge
regression per language, one against the rest, weighs them. The weights of all
landmarks fold into one matrix of n-grams by languages, so a batch of texts is
scored by one product of its presence matrix and that matrix.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
texts of any length are read whole, long ones in parts that have together exactly the
n-grams of the text; equal texts get equal results; without any labelled text every
text is ``und``; an empty table gives an empty result.
Output columns replace input columns of the same names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from workledger.llm.common import SAMPLE_CHARS, Lookup, append_columns, held_out, least_hashed, texts_of

UNDETERMINED = "und"
SPECTRUM = 3
LANDMARKS = 40
ROWS_PER_LANGUAGE = 250
RIDGE = 1e-2
BATCH = 256
# Texts by n-grams of one presence matrix: more languages have more n-grams, so fewer texts are taken at once.
CELLS = 1 << 24
PIECE = 1 << 18
BETWEEN = "\x01"

OUTPUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def _letters() -> np.ndarray:
    """Per code point: 0 for what is no letter, else the code point of the lower-case letter."""
    table = np.zeros(0x110000, np.uint32)
    for point in filter(lambda p: chr(p).isalpha(), range(0x110000)):
        low = chr(point).lower()
        table[point] = ord(low) if len(low) == 1 else point
    table[ord(BETWEEN)] = ord(BETWEEN)
    return table


_table: list[np.ndarray] = []


def letters() -> np.ndarray:
    if not _table:
        _table.append(_letters())
    return _table[0]


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts in one array, and the text each belongs to.

    A run of other characters is one border (0); BETWEEN stands between texts
    and is in no n-gram of a landmark.
    """
    raw = "".join([f" {t} {BETWEEN}" for t in texts]).encode("utf-32-le", "surrogatepass")
    codes = letters()[np.frombuffer(raw, "<u4")]
    row = np.repeat(np.arange(len(texts)), [len(t) + 3 for t in texts])
    kept = np.ones(len(codes), bool)
    kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[kept].astype(np.uint64), row[kept]


def keys_of(codes: np.ndarray):
    """The n-grams at each place as numbers, one array for each length."""
    key = codes
    for n in range(1, SPECTRUM + 1):
        yield key
        key = (key[:-1] << np.uint64(21)) | codes[n:] if len(key) else key


def long_codes(text: str):
    """The letters of a long text, in parts that begin with the last codes of the part before.

    So every n-gram is in some part, and a cut makes no border that the text does not have.
    """
    tail = np.zeros(1, np.uint64)  # the border before the text
    for at in range(0, len(text), PIECE):
        raw = text[at : at + PIECE].encode("utf-32-le", "surrogatepass")
        last = [0] if at + PIECE >= len(text) else []
        codes = np.concatenate([tail, letters()[np.frombuffer(raw, "<u4")].astype(np.uint64), np.array(last, np.uint64)])
        kept = np.ones(len(codes), bool)
        kept[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
        codes = codes[kept]
        yield codes
        tail = codes[-(SPECTRUM - 1) :]


def grams(text: str) -> np.ndarray:
    """The distinct n-grams of a text as numbers, sorted."""
    found = np.zeros(0, np.uint64)
    for codes in long_codes(text) if len(text) > PIECE else [codes_of([text])[0][:-1]]:
        found = np.unique(np.concatenate([found, *keys_of(codes)]))
    return found[found != 0]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Model:
    """Languages, the landmarks' n-grams in a hash table, and one row of weights per n-gram."""

    def __init__(self, languages: list[str], keys: np.ndarray, weights: np.ndarray):
        self.languages, self.keys, self.weights = languages, keys, weights
        self.lookup = Lookup(keys)

    def presence(self, texts: list[str]) -> np.ndarray:
        """One row per text: 1 for each n-gram of the landmarks that the text has."""
        out = np.zeros((len(texts), len(self.keys)), np.float32)

        def mark(codes: np.ndarray, of: np.ndarray) -> None:
            for key in keys_of(codes):
                column = self.lookup(key)
                place = np.flatnonzero(column >= 0)
                out[of[place], column[place]] = 1

        def together(rows: list[int]) -> None:
            codes, of = codes_of([texts[k] for k in rows])
            mark(codes, np.array(rows)[of])

        waiting, size = [], 0
        for row, text in enumerate(texts):
            if len(text) > PIECE:
                for codes in long_codes(text):
                    mark(codes, np.full(len(codes), row))
                continue
            waiting.append(row)
            size += len(text)
            if size >= PIECE:
                together(waiting)
                waiting, size = [], 0
        if waiting:
            together(waiting)
        return out

    def batches(self, rows: list):
        """The rows in parts whose presence matrix is of bounded size."""
        size = max(1, min(BATCH, CELLS // max(1, len(self.keys))))
        return (rows[k : k + size] for k in range(0, len(rows), size))

    def kernel(self, texts: list[str], columns: np.ndarray) -> np.ndarray:
        """Kernel values with sums of landmarks (``columns`` is normalised already)."""
        present = self.presence(texts)
        return present @ columns / np.sqrt(np.maximum(1, present.sum(1)))[:, None]

    def columns(self, landmarks: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(self.keys), len(landmarks)), np.float32)
        for column, own in enumerate(landmarks):
            out[own, column] = 1
        return out

    def common(self, texts: list[str], landmarks: list[np.ndarray]) -> np.ndarray:
        """Kernel values with landmarks, each given by the places of its n-grams."""
        parts = [np.zeros((0, len(landmarks)))]
        for some in self.batches(texts):
            present = self.presence(some)
            both = np.concatenate([present @ self.columns(part) for part in self.batches(landmarks)], 1).astype(np.float64)
            parts.append(both / np.sqrt(np.maximum(1, present.sum(1)))[:, None])
        return np.concatenate(parts) / np.sqrt([max(1, len(own)) for own in landmarks])


def train(sample: list[tuple[str, str]], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Fit on (text, language) rows: the first ``landmarks`` rows of each language are the landmarks.

    Memory grows with the square of the landmarks and with n-grams times languages.
    """
    by_language: dict[str, list[str]] = {}
    for text, lang in sample:
        if has_letter(text):
            by_language.setdefault(lang, []).append(text)
    languages = sorted(by_language)
    chosen = [t for lang in languages for t in by_language[lang][:landmarks]]
    if not chosen:
        return Model([], np.zeros(0, np.uint64), np.zeros((0, 0), np.float32))
    grams_of = [grams(t) for t in chosen]
    model = Model(languages, np.unique(np.concatenate(grams_of)), np.zeros((0, 0)))
    places = [np.searchsorted(model.keys, own) for own in grams_of]
    among = model.common(chosen, places)
    values, vectors = np.linalg.eigh((among + among.T) / 2)
    kept = values > 1e-6 * values.max()
    to_features = vectors[:, kept] / np.sqrt(values[kept])
    count = sum(map(len, by_language.values()))
    square, toward = ridge * np.eye(int(kept.sum())) / count, np.zeros((int(kept.sum()), len(languages)))
    for n, lang in enumerate(languages):
        features = model.common(by_language[lang], places) @ to_features
        # Each language weighs the same, whatever its share of the sample.
        square += features.T @ features / len(features)
        mean = features.mean(0)
        toward -= mean[:, None]
        toward[:, n] += 2 * mean
    solved = to_features @ np.linalg.solve(square, toward)
    weights = np.zeros((len(model.keys), len(languages)))
    for own, part in zip(places, solved, strict=True):
        weights[own] += part / max(1, len(own)) ** 0.5
    model.weights = weights.astype(np.float32)
    return model


def classify(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text; the score is the best language's part of the soft maximum."""
    names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    known = [k for k, t in enumerate(texts) if model.languages and has_letter(t)]
    for some in model.batches(known):
        values = model.kernel([texts[k] for k in some], model.weights).astype(np.float64)
        best = values.argmax(1)
        part = 1 / np.exp(4 * (values - values.max(1, keepdims=True))).sum(1)
        for k, b, p in zip(some, best.tolist(), part.tolist(), strict=True):
            names[k], scores[k] = model.languages[b], p
    return names, scores


def training_rows(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """The bounded sample: at most ``rows_per_language`` whole texts of each language outside the held-out fold.

    Every language counts, however rare; rows without a letter and texts over
    ``SAMPLE_CHARS`` are no examples and take no example's place.
    """
    usable = F.col("lang").isNotNull() & (F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"\p{L}")
    texts = docs.filter(~held_out() & usable).select("doc_id", "text", F.col("lang").alias("label"))
    return texts_of(texts, least_hashed(texts, rows_per_language), "string")


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1)."""
    return append_columns(docs, [text], OUTPUT, lambda: lambda texts: list(classify(model, texts.to_pylist())))
