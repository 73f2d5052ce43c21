"""Toxicity by cumulative-link ordinal regression over sparse word features.

The grades are ordered: the chance of a grade above k is the logistic function of
the text's evidence less the threshold of k. The evidence is a sum of weights of
the words present, shared by all thresholds, and the thresholds are kept in
order. The expected severity is the sum of those chances: 0 for surely the lowest
grade, the number of grades less one for surely the highest. With the two grades
of a yes-or-no label there is one threshold.

Defined cases: null and empty texts have no evidence; words never seen in
training say nothing; equal texts get equal results; with one grade or no
labelled text every severity is 0; texts of any length are read whole; an empty
table gives an empty result. Output columns replace input columns of the
same names.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, types as T

from workledger.llm.common import append_columns, labelled_sample
from workledger.llm.decontamination import words_of

ROWS_PER_GRADE = 3000
LEAST_TEXTS = 3
LEAST_Z = 3.0
RIDGE = 0.1
STEPS = 400
REJECT_FROM = 0.5
OUTPUT = T.StructType([T.StructField("severity", T.DoubleType()), T.StructField("grade", T.IntegerType())])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Model:
    """Weight of each known word, ordered thresholds, and the grades they part."""

    def __init__(self, weights: dict[bytes, float], thresholds: list[float], grades: list[int]):
        self.weights, self.thresholds, self.grades = weights, thresholds, grades

    def evidence(self, text: str | None) -> float:
        known = self.weights.keys() & set(words_of(text))
        return sum(self.weights[w] for w in sorted(known))

    def severity(self, text: str | None) -> tuple[float, int]:
        """Expected severity (in steps between grades), and the likeliest grade."""
        if not self.thresholds:
            return 0.0, self.grades[0] if self.grades else 0
        above = _logistic(self.evidence(text) - np.array(self.thresholds))
        chance = np.append(1.0, above) - np.append(above, 0.0)
        return float(above.sum()), self.grades[int(chance.argmax())]


def _telling_words(present: list[list[bytes]], grades: list[int], frequency: Counter) -> dict[bytes, int]:
    """Words whose texts' mean grade is LEAST_Z standard errors or more off the mean of all."""
    mean, deviation = float(np.mean(grades)), max(1e-9, float(np.std(grades)))
    total: Counter = Counter()
    for words, grade in zip(present, grades, strict=True):
        if grade:
            for w in words:
                total[w] += grade
    kept = [
        w for w, n in frequency.items()
        if n >= LEAST_TEXTS and abs(total[w] - n * mean) >= LEAST_Z * deviation * n**0.5
    ]
    return {w: k for k, w in enumerate(sorted(kept))}


def train(sample: list[tuple[str, int]]) -> Model:
    """Fit on (text, grade) rows by accelerated gradient steps on the penalised likelihood."""
    grades = sorted({grade for _, grade in sample})
    if len(grades) < 2:
        return Model({}, [], grades)
    present = [sorted(set(words_of(text))) for text, _ in sample]
    frequency = Counter(w for words in present for w in words)
    vocabulary = _telling_words(present, [grade for _, grade in sample], frequency)
    row = np.repeat(np.arange(len(sample)), [len(w) for w in present])
    column = np.array([vocabulary.get(w, -1) for words in present for w in words], np.int64)
    row, column = row[column >= 0], column[column >= 0]
    level = np.array([grades.index(grade) for _, grade in sample])
    n, d, k = len(sample), len(vocabulary), len(grades) - 1
    share = 1.0 / n
    # A word's share of the curvature bounds its step, so frequent and rare words advance alike.
    curvature = np.bincount(column, minlength=d) * share / 4 * max(1.0, np.bincount(row, minlength=n).mean() ** 0.5) + RIDGE * share
    reached = np.array([(level > j).mean() for j in range(k)])
    thresholds = -np.log(np.clip(reached, 1e-6, 1 - 1e-6) / np.clip(1 - reached, 1e-6, 1))
    weights, moved, momentum = np.zeros(d), np.zeros(d), 0.9
    shift = np.zeros(k)
    for _ in range(STEPS):
        ahead = weights + momentum * moved
        evidence = np.bincount(row, ahead[column], minlength=n) if d else np.zeros(n)
        above = _logistic(evidence[:, None] - thresholds)
        padded = np.column_stack([np.ones(n), above, np.zeros(n)])
        chance = np.maximum(1e-12, padded[np.arange(n), level] - padded[np.arange(n), level + 1])
        slope = padded * (1 - padded)  # of each boundary with respect to the evidence
        pull = (slope[np.arange(n), level] - slope[np.arange(n), level + 1]) / chance
        gradient = (np.bincount(column, pull[row], minlength=d) if d else np.zeros(0)) * share - RIDGE * share * ahead
        moved = momentum * moved + 0.1 * gradient / curvature
        weights = weights + moved
        for j in range(k):
            lower = np.where(level == j, slope[:, j + 1] / chance, 0)
            upper = np.where(level == j + 1, slope[:, j + 1] / chance, 0)
            shift[j] = (lower - upper).mean()
        thresholds = np.maximum.accumulate(thresholds + 0.5 * shift)
    kept = {w: float(weights[i]) for w, i in vocabulary.items() if abs(weights[i]) > 1e-6}
    return Model(kept, thresholds.tolist(), grades)


def training_rows(docs: DataFrame, labels: DataFrame, rows_per_grade: int = ROWS_PER_GRADE) -> list[tuple[str, int]]:
    """The bounded sample: at most ``rows_per_grade`` texts of each grade, of all grades there are."""
    return labelled_sample(docs, labels, "toxic", rows_per_grade)


def grade(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``severity`` and ``grade``."""

    def prepare():
        def compute(texts):
            found = [model.severity(t.as_py()) for t in texts]
            return [[s for s, _ in found], [g for _, g in found]]

        return compute

    return append_columns(docs, [text], OUTPUT, prepare)
