"""Quality rules by weak supervision, in DataFrame functions only.

Every rule votes good, votes bad or abstains. Expectation-maximisation over the
table of vote patterns estimates how often each rule votes, and how often it is
right, for good and for bad documents; the posterior probability of being good
takes the place of having to pass every rule. The patterns are at most three to
the power of the number of rules, whatever the number of documents, so the
estimation runs over a handful of rows.

Defined cases: null and empty texts have no words, fail the base rules and are
not kept; a text of one very long line or word is treated like any other; equal
rows get equal verdicts; with an empty table nothing is estimated. Output
columns replace input columns of the same names.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from workledger.llm.common import without
from workledger.session import materialize

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARKS = "!?"
WINDOW = 3
LEAST_WORDS = 50
ROUNDS = 50

FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks"]
OUTPUTS = [*FEATURES, "base_failed", "votes", "posterior", "kept"]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` over a value that is worked out once, also where lambdas refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """Words that lie in a window found twice or more."""
    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )

    def places(sorted_: Column) -> Column:
        # Equal windows are neighbours once sorted.
        alike = lambda i, step: F.get(sorted_, i)["h"] == F.get(sorted_, i + step)["h"]
        index = F.sequence(F.lit(0), F.size(sorted_) - 1)
        twice = F.filter(index, lambda i: F.coalesce(alike(i, 1), F.lit(False)) | F.coalesce(F.when(i > 0, alike(i, -1)), F.lit(False)))
        return F.array_sort(F.transform(twice, lambda i: F.get(sorted_, i)["i"]))

    def covered(at: Column) -> Column:
        # Each place covers what lies before the next one, three words at most.
        gaps = F.transform(at, lambda p, n: F.least(F.lit(WINDOW), F.coalesce(F.get(at, n + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda total, gap: total + gap)

    def counted(h: Column) -> Column:
        pairs = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        found = _once(F.sort_array(pairs), lambda s: _once(places(s), covered))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), found).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(_once(hashes, counted))


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts of FEATURES, taken from the whole text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    spaced = F.translate(whole, SPACES, " " * len(SPACES))
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    # One function of all the words, so that they are cut once.
    counts = _once(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    repeated = _once(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    made = without(docs, ["__counts"]).withColumn("__counts", counts)
    return made.withColumns(
        {
            "n_words": F.col("__counts.n_words"),
            "word_chars": F.length(F.translate(whole, SPACES, "")).cast("long"),
            "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
            "n_upper": (F.length(whole) - F.length(F.translate(whole, UPPER, ""))).cast("long"),
            "n_marks": (F.length(whole) - F.length(F.translate(whole, MARKS, ""))).cast("long"),
            "n_dup_lines": repeated,
            "n_repeat_words": F.col("__counts.n_repeat_words"),
        }
    ).drop("__counts")


def _vote(bad: Column, good: Column | None = None) -> Column:
    ballot = F.when(bad, F.lit(-1))
    return (ballot if good is None else ballot.when(good, F.lit(1))).otherwise(F.lit(0))


def votes() -> list[Column]:
    """The rules over the counts: 1 good, -1 bad, 0 abstains. A rule speaks where it has evidence."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return [
        _vote(n < LEAST_WORDS, n >= 2 * LEAST_WORDS),
        _vote((chars < 2 * n) | (chars > 12 * n), (chars >= 3 * n) & (chars <= 9 * n)),
        _vote(10 * F.col("n_symbols") > chars),
        _vote(5 * F.col("n_symbols") > 2 * n),
        _vote(2 * F.col("n_upper") > chars),
        _vote(2 * F.col("n_marks") > n),
        _vote(F.col("n_dup_lines") >= 3),
        _vote(100 * F.col("n_repeat_words") > 30 * n),
    ]


class Model:
    """Per class the share of documents and, per rule, the chance of each vote."""

    def __init__(self, n_rules: int):
        # Where the estimation starts: most documents are good, and a bad vote says more than a good one.
        self.good = 0.8
        self.chance = {
            True: [{1: 0.35, -1: 0.03, 0: 0.62} for _ in range(n_rules)],
            False: [{1: 0.15, -1: 0.25, 0: 0.60} for _ in range(n_rules)],
        }

    def posterior(self, pattern: tuple[int, ...]) -> float:
        logs = {}
        for good, share in ((True, self.good), (False, 1 - self.good)):
            logs[good] = math.log(share) + sum(math.log(self.chance[good][k][v]) for k, v in enumerate(pattern))
        return 1 / (1 + math.exp(min(700.0, max(-700.0, logs[False] - logs[True]))))

    def fit(self, counts: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> None:
        """Expectation and maximisation in turn; a few pseudo-counts of the start keep the classes' meaning."""
        prior = {good: [dict(c) for c in self.chance[good]] for good in (True, False)}
        total = sum(counts.values())
        strength = max(1.0, 0.05 * total)
        for _ in range(rounds if total else 0):
            weight = {True: 0.0, False: 0.0}
            seen = {good: [{v: strength * p for v, p in rule.items()} for rule in prior[good]] for good in (True, False)}
            for pattern, n in counts.items():
                p = self.posterior(pattern)
                for good, share in ((True, p * n), (False, (1 - p) * n)):
                    weight[good] += share
                    for k, vote in enumerate(pattern):
                        seen[good][k][vote] += share
            self.good = min(0.99, max(0.01, weight[True] / total))
            self.chance = {
                good: [{v: c / sum(rule.values()) for v, c in rule.items()} for rule in seen[good]] for good in (True, False)
            }

    def column(self, ballots: Column) -> Column:
        """The posterior as an expression of the array of votes."""
        evidence = F.lit(math.log(self.good / (1 - self.good)))
        for k in range(len(self.chance[True])):
            worth = {v: math.log(self.chance[True][k][v] / self.chance[False][k][v]) for v in (-1, 0, 1)}
            table = F.create_map(*[F.lit(x) for x in chain(*worth.items())])
            evidence = evidence + table[F.get(ballots, F.lit(k))]
        return 1 / (1 + F.exp(-evidence))


def judge(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the id, FEATURES, ``base_failed, votes, posterior, kept``."""
    counted = features(docs.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{text}`").alias(text)), text)
    # Written once: the counts are needed for the estimation and for the verdicts.
    counted = materialize(counted.drop(text), "features")
    rules = votes()
    voted = counted.withColumn("votes", F.array(*rules))
    model = Model(len(rules))
    # At most three to the power of the number of rules rows.
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()
    model.fit({tuple(row.votes): row.n for row in patterns})
    n, repeats = F.col("n_words"), F.col("n_repeat_words")
    judged = voted.withColumn("base_failed", (n < LEAST_WORDS) | (100 * repeats > 50 * n))
    judged = judged.withColumn("posterior", model.column(F.col("votes")))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
    return judged.select(id_column, *OUTPUTS)
