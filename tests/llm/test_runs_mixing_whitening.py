"""Periodic runs, mixing and whitening against plain versions, on odd rows and as registered."""

import hashlib
import math
import os
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_text_operators import ODD
from workledger.llm import embedding_whitening as whitening, periodic_runs as periodic, queries, source_mixing as mixing

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
with_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def split(text):
    return (text or "").encode("utf-8", "surrogatepass").split()


# --- periodic runs ----------------------------------------------------------------


def plain_runs(words, least=12):
    found = {}
    for p in range(1, len(words) // 2 + 1):
        equal = [words[i] == words[i + p] for i in range(len(words) - p)] + [False]
        at = 0
        while at < len(equal):
            if not equal[at]:
                at += 1
                continue
            stop = equal.index(False, at)
            if stop + p - at >= max(least, 2 * p):
                found.setdefault((at, stop + p), p)
            at = stop
    return sorted((a, b - a, p) for (a, b), p in found.items())


def plain_collapsed(words, runs):
    dropped = {i for a, length, p in runs for i in range(a + p, a + length)}
    return [w for i, w in enumerate(words) if i not in dropped]


def fibonacci(size):
    a, b = [0], [0, 1]
    while len(b) < size:
        a, b = b, b + a
    return b[:size]


def test_runs_equal_brute_force():
    rng = random.Random(7)
    cases = [fibonacci(k) for k in range(0, 260, 13)] + [[0] * k for k in range(40)]
    cases += [[0, 1] * k + [0] * r + [0, 1] * k for k in range(1, 15) for r in range(3)]
    for _ in range(1500):
        some = [rng.randrange(rng.choice([1, 2, 2, 3, 8])) for _ in range(rng.randint(0, 70))]
        root = [rng.randrange(3) for _ in range(rng.randint(1, 12))]
        made = some[:20] + root * rng.randint(1, 9) + root[: rng.randint(0, len(root))] + some[20:]
        cases.append(made * 2 + made[:5] if rng.random() < 0.3 else made)
    for words in cases:
        for least in (12, 3):
            assert periodic.find_runs(np.array(words, np.int64), least) == plain_runs(words, least), words


def test_texts_behind_one_another_do_not_meet():
    texts = [b"a b " * 8, b"a b " * 8, b"", b"b a " * 7 + b"c", b"a"]
    for (n, runs, collapsed), text in zip(periodic.collapse(texts), texts, strict=True):
        words = text.split()
        assert (n, runs) == (len(words), plain_runs(words))
        assert collapsed.split() == plain_collapsed(words, runs)


def test_runs_of_odd_rows(spark):
    odd = [*ODD, "la " * 5000, "a b a b\na b\ta b a b a b", "x y z " * 6 + "x y", "🙂 é " * 9]
    docs = spark.createDataFrame([(n, t, [n], n) for n, t in enumerate(odd)] * 2, "doc_id long, text string, runs array<long>, Collapsed long")
    rows = periodic.periodic_runs(docs.repartition(3)).collect()
    assert len(rows) == 2 * len(odd)
    for r in rows:
        words = split(odd[r.doc_id])
        runs = [tuple(x) for x in r.runs]
        if len(words) <= 100:
            assert runs == plain_runs(words)
        elif len(set(words)) == 1:
            assert runs == [(0, len(words), 1)]
        assert r.n_words == len(words)
        assert r.collapsed.encode().split() == plain_collapsed(words, runs)
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


def test_work_grows_with_the_words():
    def seconds(words):
        started = time.perf_counter()
        periodic.find_runs(words)
        return time.perf_counter() - started

    for make in (lambda n: np.zeros(n, np.int64), lambda n: np.array(fibonacci(n)), lambda n: np.tile(np.arange(n // 7), 7)):
        seconds(make(1000))
        assert seconds(make(80_000)) < 8 * seconds(make(20_000)) + 0.2


@with_tables
def test_registered_runs(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        words = split(texts[r.doc_id])
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        expected = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(plain_collapsed(words, runs))).hexdigest()


# --- mixing -------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """``sizes`` by source; targets by cutting and sharing anew."""
    order = sorted(sizes, key=lambda s: (s is None, [ord(c) for c in s or ""]))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    left, open_ = float(sum(sizes.values())), set(order)
    while open_ and left > 1e-9:
        share = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / share
        left = sum(max(0.0, target[s] - most * sizes[s]) for s in open_)
        for s in [s for s in open_ if target[s] >= most * sizes[s]]:
            target[s] = float(most * sizes[s])
            open_.discard(s)
    return target


def check_mix(rows, docs, most=3):
    """``docs``: (id, text, source). Everything but the choice of documents is fixed by the contract."""
    size = lambda text: len(split(text))
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += size(text)
    target = plain_targets(dict(sizes), most=most)
    expected = Counter((i, size(t), sizes[s], round(target[s], 6)) for i, t, s in docs)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in rows) == expected
    for r in rows:
        assert 0 <= r.taken <= most * r.size and (r.size == 0 or r.taken % r.size == 0)
    return target, sizes


def balanced(docs, target, most=3):
    """Rates of one source by bisection of the tilt."""
    sizes = np.array([len(split(t)) for _, t, _ in docs if split(t)], float)
    if not len(sizes):
        return sizes
    words = lambda tilt: float((sizes * np.exp(np.minimum(tilt * sizes, math.log(most)))).sum())
    low, high = -60.0, math.log(most) / sizes.min()
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if words(middle) < target else (low, middle)
    return np.exp(np.minimum(high * sizes, math.log(most)))


def random_docs(rng, n, sources):
    return [(k, "w " * rng.randint(0, 90), rng.choice(sources)) for k in range(n)]


def test_mix_of_small_tables(spark):
    rng = random.Random(5)
    sources = ["b", "a", "", None, "é", "🙂", "z", "tiny", "ﬁ"]
    docs = random_docs(rng, 700, sources[:-2] * 3 + [None] * 10)
    docs += [(900 + k, "w " * 5, "tiny") for k in range(3)] + [(None, "w w w", "a")] * 40 + [(7, docs[7][1], docs[7][2])] * 30
    docs += [(990, None, "ﬁ"), (991, "", "ﬁ")]
    frame = spark.createDataFrame([(*d, 1.5, "x") for d in docs], "doc_id long, text string, source string, size double, Taken string")
    results = []
    for parts, slice_rows in ((1, 50_000), (5, 4)):
        rows = mixing.mix(frame.repartition(parts), slice_rows=slice_rows).collect()
        target, sizes = check_mix(rows, docs)
        by_size = {}
        for source in target:
            of = [d for d in docs if d[2] == source]
            share = {(d[0], len(split(d[1]))) for d in of}
            taken = sum(r.taken for r in rows if (r.doc_id, r.size) in share and r.source_size == sizes[source])
            least = min((len(split(d[1])) for d in of if split(d[1])), default=0)
            assert abs(taken - target[source]) <= max(least, 0.01 * target[source]), source
            # Copies of every size are those of the balanced rates, but for the rounding.
            rates = balanced(of, target[source])
            sized = [d for d in of if split(d[1])]
            by_size[source] = (sum(rates), len(sized))
            copies = sum(r.copies for r in rows if (r.doc_id, r.size) in share and r.source_size == sizes[source] and r.size)
            assert abs(copies - sum(rates)) <= 2 + 0.02 * len(sized)
        results.append(Counter((r.doc_id, r.size, r.taken) for r in rows))
    again = mixing.mix(frame.repartition(7), slice_rows=50_000).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in again) == results[0]
    assert mixing.mix(frame.limit(0)).count() == 0
    nothing = mixing.mix(frame.filter("source = 'ﬁ'")).collect()
    assert [(r.size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def test_rates_solve_the_dual(spark):
    rng = random.Random(3)
    shapes = {0: [rng.randint(1, 20) for _ in range(50)], 1: [1, 5000, 3], 2: [7] * 9, 3: [rng.randint(1, 9000) for _ in range(300)], 4: [2, 3]}
    share = {0: 0.3, 1: 2.9, 2: 1.7, 3: 0.01, 4: 3.0}
    cells = [(p, s, n) for p, sizes in shapes.items() for s, n in Counter(sizes).items()]
    sources = [(p, sum(sizes), share[p] * sum(sizes)) for p, sizes in shapes.items()]
    cells = spark.createDataFrame(cells, "place long, size long, n long")
    solved = mixing.solve(cells, spark.createDataFrame(sources, "place long, source_size long, target double"))
    words = cells.join(solved, "place").groupBy("place", "target").agg(F.sum(F.col("n") * F.col("size") * mixing._rate(3)).alias("words"))
    for r in words.collect():
        assert abs(r.words - r.target) <= 1e-6 * r.target


@with_tables
def test_registered_mix(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = queries.QUERIES["op12_source_mixing"](spark, SF_DIR).collect()
    target, _ = check_mix(rows, docs)
    source = {i: s for i, _, s in docs}
    for s, wanted in target.items():
        taken = sum(r.taken for r in rows if source[r.doc_id] == s)
        assert abs(taken - wanted) <= max(min(r.size for r in rows if source[r.doc_id] == s), 0.02 * wanted)  # ten documents a source
    again = queries.QUERIES["op12_source_mixing"](spark, SF_DIR).collect()
    assert {r.doc_id: r.taken for r in rows} == {r.doc_id: r.taken for r in again}


# --- whitening ------------------------------------------------------------------------


def test_counts_and_eigenpairs():
    rng = np.random.default_rng(11)
    for t in range(120):
        d = int(rng.integers(1, 30))
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        e = [rng.random(d) * 9, 10.0 ** rng.uniform(-8, 4, d), np.full(d, 3.0), 1 + 1e-9 * rng.random(d)][t % 4]
        matrix = (q * e) @ q.T
        matrix = np.diag(np.r_[np.zeros(d // 2), np.ones(d - d // 2)]) if t % 7 == 0 else (matrix + matrix.T) / 2
        true = np.linalg.eigvalsh(matrix)
        for shift in rng.uniform(true[0] - 1, true[-1] + 1, 4):
            assert whitening.count_above(matrix, shift) == (true > shift).sum()
        pairs = whitening.leading(matrix, 4)
        values, vectors = np.array([v for v, _ in pairs]), np.array([v for _, v in pairs])
        assert len(pairs) == min(4, (true > 1e-13 * true[-1]).sum())
        assert np.abs(values - true[::-1][: len(values)]).max() <= 1e-12 * true[-1]
        assert np.abs(matrix @ vectors.T - vectors.T * values).max() <= 1e-11 * true[-1]
        assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() <= 1e-12
    assert whitening.leading(np.zeros((3, 3)), 4) == []


def check_whitened(rows, vectors, components=4):
    """``rows``: (id, component, n, deviation, whitened, explained, identity_error); ``vectors``: id to vector, as given."""
    usable = {i: v for i, v in vectors.items() if v and all(c is not None and math.isfinite(c) for c in v)}
    whole = {i: tuple(math.floor(256 * float(np.float32(c))) for c in v) for i, v in usable.items()}
    fit = np.array(sorted(set(whole.values())), dtype=np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    found = min(components, int((values > 1e-10 * values[0]).sum())) if values[0] > 0 else 0
    assert sorted((r[0], r[1]) for r in rows) == sorted((i, c + 1) for i in whole for c in range(found))
    signs = {}
    for i, c, size, deviation, white, explained, error in rows:
        assert size == n
        assert deviation == sum((n * a - int(s)) ** 2 for a, s in zip(whole[i], sums, strict=True))
        true = float((np.array(whole[i]) - sums / n) @ axes[:, c - 1]) / math.sqrt(values[c - 1])
        if abs(true) > 1e-6:
            assert signs.setdefault(c, white * true > 0) == (white * true > 0)
        assert abs(abs(white) - abs(true)) < 1e-8 * max(1, abs(true))
        assert abs(explained - values[c - 1] / values.sum()) < 1e-9
        assert 0 <= error < 1e-9
    return found


def rows_of(whitened, model):
    out = []
    for r in whitened.collect():
        for c, white in enumerate(r.whitened):
            out.append((r.vec_id, c + 1, model.n, r.deviation, white, model.explained[c], model.identity_error))
    return out


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(2)
    vectors = {k: [float(np.float32(c)) for c in rng.standard_normal(6) * [3, 2, 1, 0.5, 0.2, 0.1]] for k in range(200)}
    vectors |= {200: None, 201: [], 202: [1.0] * 5 + [None], 203: [1.0] * 5 + [float("nan")], 204: [1.0] * 5 + [float("-inf")]}
    vectors |= {205 + k: vectors[3] for k in range(60)} | {300: [-0.0, 0.0, 1e-9, -1e-9, 0.5, -0.5]}
    schema = "vec_id long, embedding array<float>, deviation string, `__y` long"
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors.items()], schema).repartition(5)
    whitened, model = whitening.whiten(frame)
    assert whitened.columns == ["vec_id", "embedding", "__y", "deviation", "whitened"]
    assert check_whitened(rows_of(whitened, model), vectors) == 4
    other = spark.createDataFrame([(400, [1.0] * 7, "x", 1)], schema)
    again, model = whitening.whiten(frame.unionByName(other))
    assert check_whitened(rows_of(again, model), vectors) == 4  # the one of another length is left out
    for few, found in ((frame.filter("vec_id = 1"), 0), (frame.filter("vec_id < 3"), 2), (frame.limit(0), 0), (frame.filter("vec_id = 200"), 0)):
        some, model = whitening.whiten(few)
        kept = {r.vec_id: r.embedding for r in few.collect()}
        assert some.count() == sum(1 for v in kept.values() if v)
        assert len(model.roots) == found
        if found:
            check_whitened(rows_of(some, model), kept)


def test_deviation_beyond_64_bits():
    x = np.array([[1 << 40, 0], [3, 4]], np.int64)
    assert whitening.deviations(x, 1 << 10, np.array([0, 0])) == [None, (3 << 10) ** 2 + (4 << 10) ** 2]


@with_tables
def test_registered_whitening(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    rows = queries.QUERIES["op13_embedding_whitening"](spark, SF_DIR)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert check_whitened([tuple(r) for r in rows.select(*names).collect()], vectors) == 4
