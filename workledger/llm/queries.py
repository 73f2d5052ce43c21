"""The operators applied to whole tables, and SQL for what SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from workledger.llm import (
    bpe,
    decontamination,
    embedding_whitening,
    language_id,
    periodic_runs,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    source_mixing,
    token_counts,
    toxicity,
    warc,
)
from workledger.llm.common import held_out


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", "doc_id", "text")


def _digest(values: Column) -> Column:
    return F.sha2(F.array_join(values, ","), 256)


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), _table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality_classifier.train(quality_classifier.training_rows(docs, labels))
    scored = quality_classifier.classify(docs, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _table(spark, sf_dir, "benchmark", "item_id", "text")
    judged = decontamination.decontaminate(_texts(spark, sf_dir), items, unnamed=True)
    digest = _digest(F.col("items")).alias("items_sha256")
    return judged.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _texts(spark, sf_dir), _table(spark, sf_dir, "labels", "doc_id", "toxic")
    graded = toxicity.grade(docs, toxicity.train(toxicity.training_rows(docs, labels)))
    rejected = F.col("severity") >= toxicity.REJECT_FROM
    return graded.select("doc_id", held_out().alias("held_out"), "severity", "grade", rejected.alias("toxic"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    coded = bpe.encode_and_decode(_texts(spark, sf_dir), vocabulary)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        _digest(F.col("ids").cast("array<string>")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_texts(spark, sf_dir))
    printed = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def token_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_texts(spark, sf_dir), pieces).select("doc_id", "n_words", "n_tokens")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = [rule.kind for rule in secret_scan.BASE]
    found = secret_scan.find_secrets(_texts(spark, sf_dir)).select("doc_id", "spans")
    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    written = lambda spans: F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in base],
        _digest(written(of_base)).alias("base_sha256"),
        F.array_join(written(F.col("spans")), ",").alias("spans"),
    )


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(spark, _table(spark, sf_dir, "pages", "page_id", "url", "html"))
    # A record whose digests do not hold fails the query.
    sound = F.when(warc.verified(records), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a digest does not hold")))
    return records.select("page_id", "payload_bytes", sound.alias("payload_digest"), "record_type", "refers_to")


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_texts(spark, sf_dir))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", "posterior")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(language_id.training_rows(_table(spark, sf_dir, "documents", "doc_id", "text", "lang")))
    named = language_id.identify(_texts(spark, sf_dir), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def _planted(docs: DataFrame) -> DataFrame:
    """Documents whose hash is divisible by ten, made periodic from some word on; the others as they are."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = docs.withColumn("__h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = (F.col("__h") % 10 == 0) & F.col("text").isNotNull()
    split = hashed.withColumn("__words", F.when(chosen, words)).withColumns(
        {"__n": F.size("__words").cast("long"), "__g": F.floor(F.col("__h") / 10).cast("long")}
    )
    begin = F.pmod(F.col("__g"), F.greatest(F.col("__n"), F.lit(1)))
    period = 1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8)).cast("long")
    placed = split.withColumn("__a", begin).withColumn("__p", period)
    a, p = F.col("__a"), F.col("__p")
    again = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("__n") - 1),
        lambda i: F.get("__words", F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
    )
    return placed.select("doc_id", F.when(F.col("__n") > 0, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_planted(_texts(spark, sf_dir)))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_min(ranked)
    written = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n"))))
    length, period = -longest["less"], longest["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return source_mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = embedding_whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*map(F.lit, model.explained.tolist())).cast("array<double>")
    return each.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "place").alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


QUERIES = {
    "op1_quality_classifier": quality,
    "op2_benchmark_decontamination": contamination,
    "op3_toxicity": toxic,
    "op4_bpe": tokens,
    "op5_simhash": near_duplicates,
    "op6_token_counts": token_numbers,
    "op7_secret_scan": secrets,
    "op8_warc": archives,
    "op9_quality_rules": rules,
    "op10_language_id": languages,
    "op11_periodic_runs": runs,
    "op12_source_mixing": mixture,
    "op13_embedding_whitening": whitened,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op2_benchmark_decontamination": rf"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS passage
  FROM (SELECT item, words, least(13, len(words)) AS size, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS pos
        FROM item_words WHERE len(words) > 0)),
doc_words AS (SELECT doc_id, {_WORDS} AS words FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, pos, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS passage
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM doc_words, sizes WHERE len(words) >= size)),
found AS (SELECT doc_id, pos, size, item FROM doc_windows JOIN item_windows USING (size, passage)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(words) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op8_warc": """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
digests AS (SELECT page_id, payload, sha1(payload) AS hexed, max(page_id) OVER (PARTITION BY payload) AS largest FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(hexed, CAST(5 * (k // 4) + 1 AS BIGINT), 5) AS BIGINT) >> CAST(15 - 5 * (k % 4) AS BIGINT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = largest THEN NULL ELSE largest END AS refers_to
FROM digests
""",
}
