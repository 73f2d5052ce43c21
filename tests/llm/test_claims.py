"""What the README claims of the learned operators: held-out labels, and plain versions of the methods."""

import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from workledger.llm import language_id, quality_rules, queries, toxicity

SF_DIR = os.environ.get("TEST_CLAIMS_DIR", "/root/testdata/sf0.01")
with_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def labels(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}


@with_tables
def test_quality_of_held_out_labels(spark, labels):
    rows = queries.QUERIES["op1_quality_classifier"](spark, SF_DIR).collect()
    assert len(rows) == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [r.predicted == labels[r.doc_id].quality for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 80 and sum(judged) >= 0.95 * len(judged)


@with_tables
def test_toxicity_of_held_out_labels(spark, labels):
    rows = queries.QUERIES["op3_toxicity"](spark, SF_DIR).collect()
    judged = Counter((labels[r.doc_id].toxic, r.toxic) for r in rows if r.held_out and r.doc_id in labels)
    # Recall over all labelled texts, also those whose label nothing in the text explains.
    assert judged[1, True] >= 0.7 * (judged[1, True] + judged[1, False]) and judged[0, True] <= 0.02 * judged[0, False]


@with_tables
def test_languages_of_held_out_rows(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.QUERIES["op10_language_id"](spark, SF_DIR).collect()
    assert len(rows) == len(lang)
    judged = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out and lang[r.doc_id]]
    assert len(judged) > 250 and sum(judged) >= 0.98 * len(judged)


def test_language_kernel_equals_plain_matrices():
    """Weights folded into n-grams against Nyström features and ridge regression written out."""
    rng = random.Random(4)
    words = {"a": "the of and to in is that was".split(), "b": "der die und das von mit ist nicht".split(), "c": "le la les des et que dans est".split()}
    sample = [(" ".join(rng.choices(own, k=12)), lang) for lang, own in words.items() for _ in range(14)]
    texts = [" ".join(rng.choices([w for own in words.values() for w in own], k=6)) for _ in range(20)]
    landmarks, ridge = 5, language_id.RIDGE
    by = defaultdict(list)
    for text, lang in sample:
        by[lang].append(text)
    chosen = [t for lang in sorted(by) for t in by[lang][:landmarks]]
    known = set().union(*[set(language_id.grams(t).tolist()) for t in chosen])
    sets = lambda t: set(language_id.grams(t).tolist()) & known
    kernel = lambda a, b: len(sets(a) & sets(b)) / math.sqrt(max(1, len(sets(a))) * max(1, len(sets(b))))
    gram = lambda xs: np.array([[kernel(x, y) for y in chosen] for x in xs])
    values, vectors = np.linalg.eigh(gram(chosen))
    some = values > 1e-6 * values.max()
    features = vectors[:, some] / np.sqrt(values[some])
    # Every language weighs the same: a row's weight is one over the rows of its language.
    x = gram([t for t, _ in sample]) @ features
    weight = np.array([1 / len(by[lang]) for _, lang in sample])
    y = np.array([[1.0 if lang == other else -1.0 for other in sorted(by)] for _, lang in sample])
    solved = np.linalg.solve(x.T @ (weight[:, None] * x) + ridge * np.eye(x.shape[1]) / len(sample), x.T @ (weight[:, None] * y))
    expected = gram(texts) @ features @ solved
    model = language_id.train(sample, landmarks=landmarks)
    assert np.abs(model.kernel(texts, model.weights) - expected).max() < 1e-3
    names, _ = language_id.classify(model, texts)
    sure = np.sort(expected, 1)[:, -1] - np.sort(expected, 1)[:, -2] > 1e-2
    assert [n for n, s in zip(names, sure, strict=True) if s] == [sorted(by)[k] for k, s in zip(expected.argmax(1), sure, strict=True) if s]


def test_posterior_equals_plain_expectation_maximisation(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["word", "other", "LOUD", "#$%", "why?", "x"], k=rng.randrange(1, 260))) for _ in range(120)]
    texts += ["same line of words here\n" * rng.randrange(1, 30) for _ in range(20)]
    rows = quality_rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    ballots = [tuple(r.votes) for r in rows]
    # One document at a time, with the start's pseudo-counts: a twentieth of the documents for each rule and class.
    start = {1: {1: 0.35, -1: 0.03, 0: 0.62}, 0: {1: 0.15, -1: 0.25, 0: 0.60}}
    chance = {c: [dict(start[c]) for _ in ballots[0]] for c in (0, 1)}
    good = 0.8

    def posterior(votes):
        odds = [share * math.prod(chance[c][k][v] for k, v in enumerate(votes)) for c, share in ((1, good), (0, 1 - good))]
        return odds[0] / sum(odds)

    for _ in range(quality_rules.ROUNDS):
        p = [posterior(v) for v in ballots]
        made = {c: [{v: 0.05 * len(ballots) * start[c][v] for v in start[c]} for _ in ballots[0]] for c in (0, 1)}
        for votes, q in zip(ballots, p, strict=True):
            for k, v in enumerate(votes):
                made[1][k][v] += q
                made[0][k][v] += 1 - q
        good = min(0.99, max(0.01, sum(p) / len(p)))
        chance = {c: [{v: n / sum(rule.values()) for v, n in rule.items()} for rule in made[c]] for c in (0, 1)}
    for r, votes in zip(rows, ballots, strict=True):
        assert abs(r.posterior - posterior(votes)) < 1e-9
        assert r.kept == (not r.base_failed and r.posterior >= 0.5)


def test_toxicity_learns_ordered_thresholds():
    """Severity is the sum of the chances to pass each threshold, which never rises from one to the next."""
    rng = random.Random(1)
    mild, harsh = ["dull", "poor"], ["awful", "vile"]
    sample = []
    for _ in range(600):
        grade = rng.choices([0, 1, 2], [6, 1, 1])[0]  # clean texts are most, as in labels
        own = {0: [], 1: mild, 2: harsh}[grade]
        sample.append((" ".join(rng.choices("some plain words about the day".split(), k=12) + ([rng.choice(own)] if own else [])), grade))
    model = toxicity.train(sample)
    severity = lambda text: model.severity(text)[0]
    assert severity("some plain words") < severity("some dull plain words") < severity("some vile plain words") <= 2
    assert list(model.thresholds) == sorted(model.thresholds)
