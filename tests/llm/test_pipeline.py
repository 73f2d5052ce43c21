"""The pipeline against a plain version of its stages, and each stage on odd rows."""

import os

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_text_operators import ODD, plain_components, plain_fingerprint, plain_secrets
from workledger.llm import decontamination, toxicity

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_pipeline_equals_plain_stages(spark):
    table = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    model = toxicity.train(toxicity.training_rows(table("documents"), table("labels")))
    docs = {r.doc_id: r.text for r in table("documents").collect()}
    docs = {i: t for i, t in docs.items() if model.severity(t)[0] < toxicity.REJECT_FROM}
    prints = {i: plain_fingerprint(t) for i, t in docs.items()}
    find = plain_components(set(prints.values()), corpus_pipeline.MAX_BITS)
    least = {}
    for i, p in prints.items():
        least[find(p)] = min(i, least.get(find(p), i))
    docs = {i: t for i, t in docs.items() if least[find(prints[i])] == i}
    items = [(str(r.item_id), r.text) for r in table("benchmark").collect()]
    automaton = decontamination.Automaton(items)  # itself tested against brute force
    scanned = {i: automaton.scan(t) for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if not (scanned[i][1] and 20 * len(scanned[i][1]) >= scanned[i][0])}

    def masked(text):
        out, at = "", 0
        for _, a, b in plain_secrets(text):
            if b > at:
                out += text[at:a] + "[SECRET]" if a >= at else ""
                at = b
        return out + text[at:]

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = {i: reference.encode(masked(t), add_special_tokens=False).ids for i, t in docs.items()}
    assert {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()} == expected


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stage_takes_odd_rows(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    rows = [(n, t, None, None, None, 1, "x", "y") for n, t in enumerate(ODD)] + [(None, None, "en", "s", 3, None, None, None)] * 2
    schema = "doc_id long, text string, lang string, source string, n_chars long, severity int, spans string, Ids string"
    docs = spark.createDataFrame(rows, schema)
    found = stage(spark, docs, SF_DIR)
    if name != "tokens":
        assert found.dtypes == docs.dtypes
    kept = found.collect()
    # Only near duplicates go here: texts without a word are all alike.
    assert (name == "near_duplicates") == (len(kept) < len(rows))
    assert {r.doc_id for r in kept} <= {r[0] for r in rows}
    assert stage(spark, docs.filter(F.lit(False)), SF_DIR).count() == 0
