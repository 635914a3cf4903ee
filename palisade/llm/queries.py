"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm import bpe, decontamination, languages, licenses, sharding, substrings, suffixes, toxicity, variants, vectors, warc, whitening
from palisade.llm import near_duplicates as near
from palisade.llm.workers import on_path

# The test pages bring no date of their own.
CAPTURED, DERIVED = "2024-01-01T00:00:00Z", "2024-02-01T00:00:00Z"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    @wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(on_path(spark), folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.array_join("sentence_ids", " ").alias("sentence_ids"), F.array_join("licenses", "|").alias("licenses"), "verdict")


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, folder, "benchmark").select("item_id", "text"), short_runs=True)


@query
def op3_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text).cast("bigint") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = sharding.shard_rows(rows, shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "global_row"
    )


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    held_out = F.coalesce(fold == 2, F.lit(False))
    labels = table(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = substrings.remove_repeats(docs, window=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query
def op6_warc_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    sources = warc.responses_of_pages(table(spark, folder, "pages"), date=CAPTURED)
    return warc.derive(sources, date=DERIVED, with_record=False).drop("record")


@query
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, folder, "documents").select("doc_id", "text"), length=50)


@query
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    done = bpe.encode(table(spark, folder, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True, keep_text=False)
    return done.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), shingle=4, percent=80)


@query
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = vectors.quantised(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    found = vectors.top_k(rows, rows.filter("vec_id % 100 = 0"), k=10)
    return found.withColumn("score", F.col("score").try_cast("bigint"))


@query
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = whitening.whole_vectors(table(spark, folder, "embeddings").select("vec_id", "embedding")).select("vec_id", "x")
    done = whitening.whiten(rows, weights="one", components=16)
    exact = F.col("deviation")
    return done.select("vec_id", "component", "n", exact.try_cast("bigint").alias("deviation"), "whitened", "explained", "identity_error", exact.alias("deviation_exact"))


@query
def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    profiles = languages.fit(docs.filter(~held_out))
    found = languages.predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = variants.word_counts(docs, least_length=6, noise=199)
    return variants.variants(counted.filter("n >= 5"), ratio=5)
