"""The text operators against brute force, on small tables with every odd case."""

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from workledger.llm import (
    bpe,
    decontamination,
    language_id,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    token_counts,
    toxicity,
    warc,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\t\n", "a", "A a A a A a A a", "one two", "same line\nsame line\n\nsame line",
    "x" * 3000, "word " * 4000, "ünï cödé 日本語 🙂 \x1c\x85", "don't I'll <|endoftext|> x<|endoftext|>", "123 456 !!! ... ### |",
    'password = "abcdef" token: short token=abcdefgh', "AKIA" + "Z9" * 10 + " deadbeef" * 5 + "0123456789abcdef" * 3, "password: token = abcdef1",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "en" if n % 2 else None, 7.5) for n, t in enumerate(ODD)]
    rows += [(3, "", None, 0.0), (None, "no id here", "en", 1.0), (None, None, None, None), (5, ODD[5], "en", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, Score double").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- tokens -------------------------------------------------------------------


def test_tokens_equal_the_librarys(spark, docs, none):
    reference = Tokenizer.from_file(PATH)
    vocabulary = bpe.Vocabulary(PATH)
    rows = bpe.encode_and_decode(docs, vocabulary).collect()
    assert len(rows) == docs.count()
    for row in rows:
        ids = reference.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == reference.decode(ids, skip_special_tokens=False)
    again = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    assert Counter((tuple(r.ids), r.decoded) for r in again) == Counter((tuple(r.ids), r.decoded) for r in rows)
    assert bpe.encode(none, vocabulary).count() == 0


def test_tokens_of_random_texts():
    rng = random.Random(5)
    reference, encoder = Tokenizer.from_file(PATH), bpe.Encoder(bpe.Vocabulary(PATH))
    parts = ["a", "the", "ing", " ", "  ", "\n", "'s", "é", "中", "12", "!", "\t", "aaaa", "<|endoftext|>", "\x85"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(3000)]
    texts += ["a" * 999, "thethe" * 200, "é" * 333, "=" * 500]
    found = [np.frombuffer(x, "<i4").tolist() for x in encoder.encode(texts)]
    assert found == [reference.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_text_is_encoded_in_pieces(monkeypatch):
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    reference, encoder = Tokenizer.from_file(PATH), bpe.Encoder(bpe.Vocabulary(PATH))
    text = "some words,  and\n\nmore of them " * 40 + "x" * 200
    assert "".join(bpe.pieces(text, 50)) == text
    assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == reference.encode(text, add_special_tokens=False).ids


# --- near duplicates ----------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    listed = sorted(parent)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return find


def test_fingerprints_and_components(spark, docs, none):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [rng.choice(words) for _ in range(200)]
    texts = [" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in range(60)]
    more = spark.createDataFrame([(100 + n, t, None, None) for n, t in enumerate(texts)], docs.schema)
    rows = simhash.near_duplicates(docs.unionByName(more)).collect()
    of = [(r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in rows]
    sent = {(r.doc_id, plain_fingerprint(r.text)) for r in docs.unionByName(more).collect()}
    assert {(i, p) for i, p, _ in of} == sent and len(rows) == docs.count() + 60
    find = plain_components({p for _, p, _ in of}, 3)
    least = {}
    for i, p, _ in of:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    assert all(c == least.get(find(p)) for _, p, c in of)
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("block", [4, 1024])
def test_links_of_a_dense_group(spark, block):
    rng = random.Random(1)
    start = rng.getrandbits(64)
    prints = {start ^ sum(1 << b for b in rng.sample(range(10), rng.randrange(5))) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 3, block)
    assert edges.count() <= 60 * len(prints)
    roots = {r.u & (2**64 - 1): r.root for r in simhash.components(edges).collect()}
    find = plain_components(prints, 3)
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(roots.get(p, p - (1 << 64) if p >> 63 else p))
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({next(iter(g)) for g in groups.values()})


# --- contamination ------------------------------------------------------------


@pytest.mark.parametrize("block", [10, 200_000])
def test_contamination(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    long = " ".join(f"q{i}" for i in range(30))
    items = [(10, "One TWO"), (9, long), (11, long), (12, None), (13, "--"), (None, "a"), (14, "ünï cödé")]
    texts = [long.upper(), "start, " + long[:60] + " end", f"{long[:45]} {long}", "one-two " * 3]
    more = spark.createDataFrame([(200 + n, t, None, None) for n, t in enumerate(texts)], docs.schema)
    rows = decontamination.decontaminate(docs.unionByName(more), spark.createDataFrame(items, "item_id long, text string")).collect()
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for row in rows:
        words, hit, found = pattern.findall(lower(row.text)), set(), set()
        for name, text in items:
            own = pattern.findall(lower(text)) if name is not None else []
            size = min(13, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                for at in range(len(words) - size + 1):
                    if words[at : at + size] == own[i : i + size]:
                        hit.update(range(at, at + size))
                        found.add(str(name))
        assert (row.n_words, row.n_hit, row["items"]) == (len(words), len(hit), sorted(found))
        assert row.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(words))
        assert {w for a, b in row.hits for w in pattern.findall(lower(row.text[a:b]))} == {words[k] for k in hit}
    empty = decontamination.decontaminate(docs, spark.createDataFrame([], "item_id long, text string"))
    assert empty.filter("contaminated or n_hit > 0").count() == 0
    assert decontamination.decontaminate(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("block", [10, 200_000])
def test_contamination_holds_one_automaton_a_stage_and_equals_the_sql(spark, docs, monkeypatch, tmp_path, block):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    long = " ".join(f"q{i}" for i in range(30))
    items = spark.createDataFrame([(10, "One TWO"), (9, long), (11, long[20:] + " one two"), (12, None), (13, "--"), (14, "ünï cödé")], "item_id long, text string")
    texts = [long.upper(), "start, " + long[:60] + " end", f"{long[:45]} one two {long}"]
    more = spark.createDataFrame([(200 + n, t, None, None) for n, t in enumerate(texts)], docs.schema)
    all_docs = docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(more)
    assert len(list(decontamination.item_blocks(items))) == (3 if block == 10 else 1)
    plan = decontamination.decontaminate(all_docs, items)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert_equals_sql(spark, all_docs, items, tmp_path)


def plain_contamination(items, text):
    words, hit, found = decontamination.words_of(text), set(), set()
    for name, own in ((name, decontamination.words_of(t)) for name, t in items):
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for at in range(len(words) - size + 1):
            if tuple(words[at : at + size]) in windows:
                hit.update(range(at, at + size))
                found.add(name)
    return len(words), sorted(hit), sorted(found, key=lambda name: name or "")


@pytest.mark.parametrize("lane", [1, 5, 64])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh"])
def test_the_automaton_equals_brute_force(monkeypatch, lane, letters):
    """Items of all lengths that overlap, repeat and end in one another; lanes that cut every window."""
    monkeypatch.setattr(decontamination, "LANE", lane)
    rng = random.Random(lane)

    def some(n):
        return " ".join(rng.choice(letters) for _ in range(n))

    for _ in range(60):
        items = [(rng.choice([None, "1", str(i)]), some(rng.choice([0, 2, 3, 12, 13, 14, 20, 40]))) for i in range(rng.randint(0, 6))]
        parts = [" ".join(t for _, t in items)[rng.randint(0, 60) :][: rng.randint(0, 200)] for _ in range(5)]
        texts = [None, "", *[f"{some(rng.randint(0, 80))} zz {part} {some(3)}" for part in parts]]
        found = decontamination.Automaton(items).scan_all(texts)
        assert [f[:3] for f in found] == [plain_contamination(items, t) for t in texts]


def test_the_automatons_size_is_bounded_by_the_items():
    rng = random.Random(4)
    dense = [("1", " ".join(chr(rng.randint(0x100, 0x2FF)) for _ in range(20_000)))]  # the shortest words, all windows different
    prose = [(str(n), " ".join(rng.choice(["of", "question", "answer", "river", "the"]) + str(rng.randint(0, 99)) for _ in range(60))) for n in range(300)]
    for items in (dense, prose):
        assert decontamination.Automaton(items).nbytes() < 100 * sum(len(t) for _, t in items)


@pytest.mark.parametrize("block", [1, 200_000])
def test_columns_named_like_the_operators_own_stay(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", block)
    docs = spark.createDataFrame([("p", "f", "one two", "w", 1)], "__place string, __found string, Text string, words string, N_Hit int")
    items = spark.createDataFrame([(1, "one two"), (2, "two")], "item_id long, text string")
    found = decontamination.decontaminate(docs, items, "text")
    row = found.drop("hits").first()
    assert found.columns == ["__place", "__found", "Text", "words", "n_words", "n_hit", "items", "hits", "n_items", "contaminated"]
    assert tuple(row) == ("p", "f", "one two", "w", 2, 2, ["1", "2"], 2, True)


def test_items_without_id_count_as_in_the_sql(spark, monkeypatch, tmp_path):
    from corpus_pipeline import drop_contaminated

    docs = spark.createDataFrame([(1, "no name here"), (2, "other words"), (3, "named one, no name"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "no name"), (None, "here"), (5, "named one"), (6, None)], "item_id long, text string")
    assert_equals_sql(spark, docs, items, tmp_path)
    assert [r.doc_id for r in drop_contaminated(spark, docs, str(tmp_path)).sort("doc_id").collect()] == [2, 4]
    monkeypatch.setattr(decontamination, "BLOCK_CHARS", 1)
    assert_equals_sql(spark, docs, items, tmp_path / "blocks")
    assert [r.doc_id for r in drop_contaminated(spark, docs, str(tmp_path)).sort("doc_id").collect()] == [2, 4]


def assert_equals_sql(spark, docs, items, folder):
    import duckdb

    from workledger.llm import queries

    connection = duckdb.connect()
    for name, table in (("documents", docs), ("benchmark", items)):
        table.write.parquet(f"{folder}/{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')")
    expected = connection.execute(queries.ORACLES["op2_benchmark_decontamination"]).fetchall()
    found = queries.contamination(spark, str(folder)).collect()
    assert sorted(map(tuple, found)) == sorted(expected)
    assert any(row.n_hit for row in found)


# --- secrets ------------------------------------------------------------------


def plain_secrets(text):
    text, out = text or "", []
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(out)]


def test_secrets(docs, none):
    rows = secret_scan.find_secrets(docs, masked="masked").collect()
    for row in rows:
        assert [tuple(s) for s in row.spans if s.kind in ("assign", "access", "hex")] == plain_secrets(row.text)
        expected, at = "", 0
        for _, a, b in row.spans:
            if b > at:
                expected += (row.text[at:a] + "[SECRET]") if a >= at else ""
                at = b
        assert row.masked == (expected + row.text[at:] if row.spans else row.text)
    assert sum(len(r.spans) for r in rows) >= 4
    assert secret_scan.find_secrets(none).count() == 0


def test_secrets_of_random_texts_and_minimal_automaton():
    rng = random.Random(8)
    parts = ["password", "toKen", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "abcdef", "0123456789abcdef", "AKIA", "ABCD1234", "é", "\n", "ſ", ","]
    texts = ["".join(rng.choices(parts, k=rng.randrange(50))) for _ in range(3000)]
    scanner = secret_scan.Scanner(secret_scan.BASE)
    assert scanner.scan([t.encode() for t in texts]) == [plain_secrets(t) for t in texts]
    small = secret_scan.Automaton((secret_scan.Rule("x", "ab|cb"),), anywhere=False)
    assert len(small.step) == 4  # start, one letter read, end, dead


def plain_added(text):
    """Spans of the rules that the scan adds, by the expressions as they stand."""
    out = []
    for n, rule in enumerate(secret_scan.ADDED):
        out += [(m.start(), n, m.end()) for m in re.finditer(rule.pattern, text) if m.end() - m.start() >= rule.least]
    return [(secret_scan.ADDED[n].kind, a, b) for a, n, b in sorted(out)]


def test_all_rules_in_random_texts(monkeypatch):
    rng = random.Random(12)
    parts = ["eyJ", "eyJh", ".", "abcDEF012-_", "ghp_", "xoxb-", "0123456789abcdefABCDEF", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", " ", "\n", "é", "secret=", "AKIA", "Z" * 20]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    added = {rule.kind for rule in secret_scan.ADDED}
    scanner = secret_scan.Scanner()
    for long_lane in (secret_scan.LONG_LANE, 0):
        monkeypatch.setattr(secret_scan, "LONG_LANE", long_lane)
        found = scanner.scan([t.encode() for t in texts])
        assert [[s for s in spans if s[0] in added] for spans in found] == [plain_added(t) for t in texts]
        assert [[s for s in spans if s[0] not in added] for spans in found] == [plain_secrets(t) for t in texts]
    assert {k for spans in found for k, _, _ in spans} == {rule.kind for rule in secret_scan.RULES}


def test_secret_scan_is_linear():
    scanner = secret_scan.Scanner()

    def seconds(text):
        started = time.perf_counter()
        spans = scanner.scan([text.encode()])[0]
        secret_scan.redacted(text, spans)
        return time.perf_counter() - started

    real = " eyJ" + "a" * 30 + ".eyJbbbb.cccc"
    for make in (lambda n: "eyJ" * (n // 3) + real, lambda n: "a" * n + real, lambda n: "secret = abcdefgh " * (n // 18), lambda n: "eyJ." * (n // 4) + real):
        short, long = (min(seconds(make(n)) for _ in range(2)) for n in (250_000, 1_000_000))
        assert long < 10 and long < 8 * short + 0.2


# --- archives -----------------------------------------------------------------


def test_archives_round_trip(spark):
    html = ["<p>é</p>", "", None, "x" * 200_000, "<p>é</p>", "unique", "<p>é</p>\r\n\r\nmore"]
    rows = [(n, f"http://a.example/{n}\r\nX: y", h) for n, h in enumerate(html)] + [(4, None, "<p>é</p>"), (None, "u", "<p>é</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    records = warc.round_trip(spark, pages, payloads=True).collect()
    assert len(records) == len(rows)
    largest = {}
    for n, _, h in rows:
        if n is not None:
            largest[h or ""] = max(n, largest.get(h or "", n))
    expected = Counter()
    for n, _, h in rows:
        raw = (h or "").encode()
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        first = n == largest[h or ""]
        expected[n, len(raw), sha, "response" if first else "revisit", None if first else largest[h or ""]] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records) == expected
    assert all(r.block_ok and r.payload_ok is not False for r in records)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_archive_reader_is_incremental_and_strict():
    import gzip
    import io

    made = [warc.record(n, None, bytes([n]) * 70_000, None, False) for n in range(3)]
    packed = b"".join(map(gzip.compress, made))
    found = list(warc.members(io.BytesIO(packed)))
    assert [content for _, content in found] == made
    assert [packed[o : o + 2] for o, _ in found] == [b"\x1f\x8b"] * 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(packed[:-5])))
    with pytest.raises(ValueError):
        warc.parse(made[0][:-1])
    broken = made[1].replace(b"\x01" * 5, b"\x02" * 5, 1)
    assert not warc.parse(broken)["payload_ok"]


# --- rules --------------------------------------------------------------------


def test_rules_count_as_plain_python(docs, none):
    rows = quality_rules.judge(docs).collect()
    counted = Counter()
    for row in docs.collect():
        text = row.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        counted[row.doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed] += 1
    assert counted == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality_rules.judge(none).count() == 0


def test_estimation_finds_the_reliable_rule():
    rng = random.Random(2)
    counts = Counter()
    for _ in range(4000):
        good = rng.random() < 0.7
        vote = lambda right: (1 if good else -1) if rng.random() < right else (-1 if good else 1)
        counts[vote(0.95), vote(0.9), vote(0.6)] += 1
    model = quality_rules.Model(3)
    model.fit(counts)
    assert model.posterior((1, 1, -1)) > 0.8 and model.posterior((-1, -1, 1)) < 0.2
    assert model.chance[True][0][1] > model.chance[True][2][1]


# --- learned scores -----------------------------------------------------------


def test_quality_classifier(spark, docs, none):
    rng = random.Random(4)
    good = [" ".join(rng.choices(["the", "river", "was", "calm", "and", "wide"], k=60)) for _ in range(60)]
    bad = ["!!".join(rng.choices(["BUY", "NOW", "CLICK", "WIN"], k=60)) for _ in range(60)]
    model = quality_classifier.train([(t, 1) for t in good[:40]] + [(t, 0) for t in bad[:40]])
    assert all(model.score(t) >= 0.5 for t in good[40:]) and all(model.score(t) < 0.5 for t in bad[40:])
    rows = quality_classifier.classify(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert quality_classifier.classify(none, model).count() == 0
    assert quality_classifier.train([]).score("x") == 0.5


@pytest.mark.parametrize("grades", [2, 4])
def test_toxicity_grades_are_ordered(docs, none, grades):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(200)]
    sample = []
    for _ in range(800):
        grade = rng.randrange(grades)
        sample.append((" ".join(rng.sample(plain, 20) + ["vile", "foul", "nasty"][:grade]), grade))
    model = toxicity.train(sample)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == grades - 1
    expected = [model.severity("w1 w2 " + " ".join(["vile", "foul", "nasty"][:g]))[0] for g in range(grades)]
    assert expected == sorted(expected) and expected[0] < 0.5 and expected[-1] > grades - 1.6
    rows = toxicity.grade(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.severity <= grades - 1 for r in rows)
    assert toxicity.grade(none, model).count() == 0
    assert toxicity.train([("a", 0)]).severity("a") == (0.0, 0)


def test_language_id(docs, none):
    rng = random.Random(7)
    words = {"aa": ["sun", "moon", "stone", "river"], "bb": ["çok", "ağaç", "güneş", "su"], "cc": ["мир", "день", "вода"]}
    sample = [(" ".join(rng.choices(own, k=8)), lang) for lang, own in words.items() for _ in range(60)]
    model = language_id.train(sample, landmarks=10)
    for lang, own in words.items():
        names, scores = language_id.classify(model, [" ".join(own).upper()])
        assert names == [lang] and 0 < scores[0] <= 1
    rows = language_id.identify(docs, model).collect()
    assert len(rows) == docs.count()
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) for r in rows)
    alone = [language_id.classify(model, [t]) for t in ODD]
    together = language_id.classify(model, ODD)
    assert [a[0][0] for a in alone] == together[0]
    assert language_id.identify(none, model).count() == 0
    assert language_id.classify(language_id.train([]), ["abc"]) == (["und"], [0.0])


def test_every_language_is_learned(spark):
    rng = random.Random(9)
    alphabets = {f"l{n:02}": [chr(0x400 + 12 * n + k) for k in range(12)] for n in range(20)}
    word = lambda lang: "".join(rng.choices(alphabets[lang], k=5))
    rows = [(100 * n + k, " ".join(word(lang) for _ in range(9)), lang) for n, lang in enumerate(alphabets) for k in range(40 if n < 16 else 8)]
    # Rows without text, and a language of held-out rows only.
    out = [i for i in range(9000, 9900) if zlib.crc32(str(i).encode()) % 3 == 1]
    rows += [(i, None, "l19") for i in range(5000, 5300)] + [(i, "some words", "held") for i in out]
    sample = language_id.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 6)
    sizes = Counter(lang for _, lang in sample)
    inside = Counter(lang for i, t, lang in rows if t and zlib.crc32(str(i).encode()) % 3 != 1)
    assert sizes == {lang: min(6, n) for lang, n in inside.items()} and set(sizes) == set(alphabets)
    model = language_id.train(sample)
    assert language_id.classify(model, [" ".join(own) for own in alphabets.values()])[0] == list(alphabets)


def test_long_text_has_the_same_presence(monkeypatch):
    model = language_id.train([("the quick brown fox jumps", "a"), ("eine kurze zeile mehr", "b")])
    text = "the quick, brown fox; jumps eine kurze zeile mehr " * 9
    whole = model.presence([text])
    monkeypatch.setattr(language_id, "PIECE", 40)
    assert (model.presence([text]) == whole).all()


def plain_grams(text):
    letters = "".join(c.lower() if len(c.lower()) == 1 else c for c in (c if c.isalpha() else " " for c in f" {text} "))
    spaced = re.sub(" +", " ", letters)
    return {spaced[k : k + n] for n in (1, 2, 3) for k in range(len(spaced) - n + 1)} - {" "}


def test_every_cut_has_the_grams_of_the_whole_text(monkeypatch):
    """Brute force over all cut positions, words without end and long runs of other characters."""
    texts = ["The quick, brown fox; jumps 12 times", "endless" * 12, "a" + " ,.-" * 20 + "b c" + "\n" * 9, "ab", "é ß Ǆ日本", "1234567890" * 3 + "x"]

    def key(gram):
        number = 0
        for c in gram:
            number = number << 21 | (0 if c == " " else ord(c))
        return number

    for piece in range(1, 40):
        monkeypatch.setattr(language_id, "PIECE", piece)
        for text in texts:
            expected = {key(g) for g in plain_grams(text)} - {0}
            assert set(language_id.grams(text).tolist()) == expected, (piece, text)
            every = sorted({key(g) for t in texts for g in plain_grams(t)} - {0})
            model = language_id.Model([], np.array(every, np.uint64), np.zeros((0, 0)))
            present = model.presence([text, "zz", text])
            assert {every[k] for k in np.flatnonzero(present[0])} == expected and (present[0] == present[2]).all()


def test_shared_bytes_are_tallied():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**64, 500, dtype=np.uint64)
    b = a ^ (rng.integers(0, 2**64, 500, dtype=np.uint64) & rng.integers(0, 2**64, 500, dtype=np.uint64) & rng.integers(0, 2**64, 500, dtype=np.uint64))
    plain = [sum(x == y for x, y in zip(int(p).to_bytes(8, "little"), int(q).to_bytes(8, "little"), strict=True)) for p, q in zip(a, b, strict=True)]
    assert simhash._shared_bytes(a ^ b).tolist() == plain and len(set(plain)) > 3


# --- token counts -------------------------------------------------------------


def plain_edges(word, scores, floor, longest):
    """Per end the (begin, piece, score) of every piece that ends there, or of an unknown character's bytes."""
    out = [[]]
    for end in range(1, len(word) + 1):
        here = [(a, word[a:end], scores[word[a:end]]) for a in range(max(0, end - longest), end) if word[a:end] in scores]
        if word[end - 1] not in scores:
            here.append((end - 1, None, len(word[end - 1].encode()) * floor))
        out.append(here)
    return out


def test_token_counts(docs, none):
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    estimated = token_counts.estimate_scores(docs, pieces)
    for scores in (token_counts.scores_by_rank(pieces), estimated):
        known = dict(zip(pieces, scores, strict=True))
        floor, longest = min(scores) - token_counts.UNKNOWN_PENALTY, max(map(len, pieces))

        def plain(word):
            best = [(0.0, 0)]
            for here in plain_edges(word, known, floor, longest)[1:]:
                best.append(max((best[a][0] + s, best[a][1] - (1 if p else round(s / floor))) for a, p, s in here))
            return -best[-1][1]

        counts = {}
        for row in token_counts.count_tokens(docs, pieces, scores=scores).collect():
            words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
            for w in words:
                if w not in counts:
                    counts[w] = plain("▁" + w)
            assert (row.n_words, row.n_tokens) == (len(words), sum(counts[w] for w in words))
    counter = token_counts.Counter(pieces, estimated)
    assert counter.count_long("▁international") == counter.count(["▁international"])[0]
    assert token_counts.count_tokens(none, pieces).count() == 0


def test_scores_are_those_of_plain_expectation_maximisation(spark):
    rng = random.Random(9)
    pieces = ["▁", "a", "b", "ab", "ba", "aba", "▁a", "bb", "▁ab", "c"]
    words = ["".join(rng.choices("abcé", [5, 4, 1, 0.3], k=rng.randrange(1, 9))) for _ in range(60)] + ["ab" * 300, "é", "abé" * 200]
    texts = [" ".join(rng.choices(words, k=20)) for _ in range(30)] + [None, "", " \n"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    scores = dict(zip(pieces, token_counts.scores_by_rank(pieces), strict=True))
    total = Counter(w for t in texts for w in (t or "").split())
    for _ in range(3):
        floor, seen = min(scores.values()) - token_counts.UNKNOWN_PENALTY, dict.fromkeys(pieces, token_counts.UNSEEN)
        for word, n in total.items():
            edges = plain_edges("▁" + word, scores, floor, 3)
            size = len(word) + 1
            forward, behind = [0.0] + [-np.inf] * size, [-np.inf] * size + [0.0]
            for end in range(1, size + 1):
                for a, _, s in edges[end]:
                    forward[end] = np.logaddexp(forward[end], forward[a] + s)
            for end in range(size, 0, -1):
                for a, p, s in edges[end]:
                    behind[a] = np.logaddexp(behind[a], s + behind[end])
                    if p:
                        seen[p] += n * np.exp(forward[a] + s + behind[end] - forward[size])
        scores = {p: float(np.log(c / sum(seen.values()))) for p, c in seen.items()}
    found = token_counts.estimate_scores(docs, pieces, rounds=3)
    assert np.abs(np.array(found) - np.array(list(scores.values()))).max() < 1e-7


def test_folds_and_samples(spark):
    from workledger.llm.common import held_out, labelled_sample

    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), (F.col("id") % 2).alias("quality"))
    assert {r.doc_id for r in df.filter(held_out()).collect()} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 3 == 1}
    sample = labelled_sample(df, df.unionByName(df), "quality", 8)
    assert all(zlib.crc32(t.split()[1].encode()) % 3 != 1 for t, _ in sample) and len(sample) <= 16
    assert labelled_sample(df.limit(0), df, "quality", 8) == [] == labelled_sample(df, df.limit(0), "quality", 8)


def test_sample_takes_usable_texts_and_ids_of_any_kind(spark, monkeypatch):
    from workledger.llm import common

    rows = [(f"id{n}", f"text {n}" if n % 2 else "x" * 100, n % 3) for n in range(90)]
    df = spark.createDataFrame(rows, "doc_id string, text string, quality int")
    absent = spark.createDataFrame([(f"no{n}", n % 3) for n in range(200)], "doc_id string, quality int")
    labels = df.select("doc_id", "quality").unionByName(absent)
    learned = {i for i, t, _ in rows if zlib.crc32(i.encode()) % 3 != 1 and len(t) < 50}
    sample = common.labelled_sample(df, labels, "quality", 1000, max_chars=50)
    assert {t for t, _ in sample} == {t for i, t, _ in rows if i in learned}
    assert Counter(q for _, q in common.labelled_sample(df, labels, "quality", 4, max_chars=50)) == {0: 4, 1: 4, 2: 4}
    monkeypatch.setattr(common, "SAMPLE_TOTAL", 3 * 2 * common.SAMPLE_CHARS)
    assert Counter(q for _, q in common.labelled_sample(df, labels, "quality", 4, max_chars=50)) == {0: 2, 1: 2, 2: 2}


def test_repeated_rows_take_one_place_in_a_sample(spark):
    from workledger.llm.common import labelled_sample

    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    df = spark.createDataFrame([(i, f"text {i}", i % 2) for i in ids], "doc_id long, text string, quality int")
    once = labelled_sample(df, df, "quality", 5)
    assert len(once) == 10
    often = df.filter(F.col("text").isin([t for t, _ in once])).crossJoin(spark.range(50)).drop("id")
    assert labelled_sample(df.unionByName(often), df.unionByName(often), "quality", 5) == once


def test_every_grade_is_learned(spark):
    rows = [(i, f"text of {i}", i % 20) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sample = toxicity.training_rows(df, df, 4)
    assert {g for _, g in sample} == set(range(20)) and len(sample) == 80
    assert toxicity.train(sample).grades == list(range(20))
