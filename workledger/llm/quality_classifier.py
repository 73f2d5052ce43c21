"""Quality by compression: a text is like the good or like the bad examples it compresses with.

One zstandard dictionary is built from good, one from bad labelled text. A text
is compressed with both; the difference of the two sizes, over the size without
any dictionary, is calibrated to a probability by logistic regression on labelled
texts that are in neither dictionary. Long texts are compressed block by block,
so that a dictionary counts for every part of them.

Defined cases: null and empty texts get the score of a difference of zero; equal
texts get equal scores; without labelled texts of both kinds every score is 0.5;
texts of any length are read whole; an empty table gives an empty result. Output columns replace input columns of the
same names.
"""

from __future__ import annotations

import numpy as np
import zstandard
from pyspark.sql import DataFrame, types as T

from workledger.llm.common import append_columns, labelled_sample

ROWS_PER_LABEL = 1500
DICTIONARY_BYTES = 110 << 10
BLOCK_BYTES = 512
LEVEL = 3
OUTPUT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def blocks(text: str | None) -> list[bytes]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]


def build_dictionary(texts: list[str], size: int) -> bytes:
    """A trained dictionary; where there is too little text to train on, the text itself."""
    samples = [b for t in texts for b in blocks(t)]
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Model:
    """Dictionaries of bad (0) and good (1) text, and the calibration of their difference."""

    def __init__(self, dictionaries: tuple[bytes, bytes] | None, slope: float = 0.0, offset: float = 0.0):
        self.dictionaries, self.slope, self.offset = dictionaries, slope, offset
        self._compressors = None

    def __getstate__(self):
        return {**self.__dict__, "_compressors": None}

    def _open(self):
        made = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)]
        for data in self.dictionaries:
            dictionary = zstandard.ZstdCompressionDict(data)
            dictionary.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, write_content_size=False, write_dict_id=False))
        return made

    def difference(self, text: str | None) -> float:
        """Above zero where good text's dictionary saves more."""
        if not text or not self.dictionaries:
            return 0.0
        self._compressors = self._compressors or self._open()
        plain, bad, good = (sum(len(c.compress(b)) for b in blocks(text)) for c in self._compressors)
        return (bad - good) / plain

    def score(self, text: str | None) -> float:
        if not self.dictionaries:
            return 0.5
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.difference(text) + self.offset, -30, 30))))


def _calibrated(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic regression, both labels weighing the same, by Newton's steps."""
    x = np.column_stack([values, np.ones(len(values))])
    scale = max(1e-9, float(np.std(values)))
    x[:, 0] /= scale
    weight = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    beta = np.zeros(2)
    penalty = np.diag([1e-2 * len(labels) / 100, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (labels - p)) - penalty @ beta
        curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(2)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def train(sample: list[tuple[str, int]]) -> Model:
    """Fit on (text, label) rows: of each label every second row goes into its dictionary, the others calibrate."""
    by_label = {label: [t for t, own in sample if own == label and t] for label in (0, 1)}
    if min(map(len, by_label.values())) < 2:
        return Model(None)
    sources = [by_label[label][::2] for label in (0, 1)]
    # Equal sizes, or the larger dictionary would win on size alone.
    size = min(DICTIONARY_BYTES, *[max(1024, sum(map(len, texts)) // 4) for texts in sources])
    model = Model(tuple(build_dictionary(texts, size) for texts in sources))
    held = [(t, label) for label in (0, 1) for t in by_label[label][1::2]]
    values = np.array([model.difference(t) for t, _ in held])
    model.slope, model.offset = _calibrated(values, np.array([label for _, label in held]))
    return model


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_label: int = ROWS_PER_LABEL) -> list[tuple[str, int]]:
    return labelled_sample(docs, labels, "quality", rows_per_label)


def classify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher is better) and ``predicted`` (1 from a score of 0.5 on)."""

    def prepare():
        def compute(texts):
            scores = [model.score(t.as_py()) for t in texts]
            return [scores, [int(s >= 0.5) for s in scores]]

        return compute

    return append_columns(docs, [text], OUTPUT, prepare)
