"""From raw documents to token ids: five stages, each over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each as
Parquet into the shared folder and reads it again for the next.

Defined cases, for every stage: a null text is an empty one (no evidence, fingerprint
zero, no words, no secrets, no tokens) and its row is kept or dropped as such; texts of
any length are read whole; rows without id and repeated ids are rows like any
other; equal rows are equal near duplicates, of which one stays, and get equal results
elsewhere; an empty table gives an empty one; further columns are carried
unchanged, whatever their names, up to the last stage, which returns the
id and its own columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from workledger.llm import bpe, decontamination, secret_scan, simhash, toxicity
from workledger.session import materialize

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHINGLE = 3
MAX_BITS = 3


def _apart(docs: DataFrame) -> DataFrame:
    """The whole row in one column beside the text, so that no output clashes with a column."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").alias("__text"))


def _rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition).select("__row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected severity is below the limit stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(toxicity.training_rows(docs, labels))
    return _rows(toxicity.grade(_apart(docs), model, "__text"), F.col("severity") < toxicity.REJECT_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays; of equal rows one."""
    content = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(F.struct(F.col("doc_id").alias("id"), content.alias("content")).alias("__key"), "text")
    found = simhash.near_duplicates(keyed, "__key", "text", SHINGLE, MAX_BITS)
    first = found.select(F.col("component_id.id").alias("id"), F.col("component_id.content").alias("content")).distinct()
    no_id = F.lit(-(1 << 63)).cast("long")
    kept = first.select(F.coalesce("id", no_id).alias("__id"), F.col("content").alias("__content"))
    rows = docs.select(F.coalesce("doc_id", no_id).alias("__id"), content.alias("__content"), whole.alias("__row"))
    one_each = rows.join(kept, ["__id", "__content"], "left_semi").dropDuplicates(["__id", "__content"])
    return one_each.select("__row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _rows(decontamination.decontaminate(_apart(docs), benchmark, "__text", unnamed=True), ~F.col("contaminated"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret found is masked, and the number of characters follows."""
    found = secret_scan.find_secrets(_apart(docs), text="__text", masked="__masked")
    masked = F.col("__masked")
    changed = {"text": masked, "n_chars": F.when(F.size("spans") > 0, F.length(masked).cast("long")).otherwise(F.col("__row.n_chars"))}
    return found.select(*[changed.get(c, F.col("__row")[c]).alias(c) for c in docs.columns])


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the digest of what they decode to."""
    vocabulary = bpe.Vocabulary(TOKENIZER)
    coded = bpe.encode_and_decode(docs.select("doc_id", "text"), vocabulary)
    decoded = F.sha2("decoded", 256).alias("decoded_sha256")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", decoded)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]

# Fingerprints, the fitted model and merging are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
