"""A corpus made ready for training: five stages over ``documents``.

Each stage takes all that the one before kept. Toxic documents go, of each group of near duplicates one document stays,
passages that stand elsewhere too are cut out, documents that hold a benchmark item go, and the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palisade.llm import bpe, decontamination, substrings, toxicity
from palisade.llm.near_duplicates import drop_near_duplicates
from palisade.llm.workers import on_path
from palisade.session import settle

# A document goes if it is more likely toxic than not.
TOXIC = 0.5
PASSAGE_WORDS = 50

# The stages learn from labels, so SQL can't give the rows.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose score is ``TOXIC`` or more; the classifier learns from the labelled ones among ``docs``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), name="toxic score")
    return scored.filter(F.col("toxic score") < TOXIC).select(*docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by a similarity of 0.8 on five-word shingles."""
    return drop_near_duplicates(docs, shingle=5, percent=80).select(*docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts all copies of passages of ``PASSAGE_WORDS`` words or more; a text that loses nothing stays as it is."""
    cut = substrings.remove_repeats(docs, window=PASSAGE_WORDS, layout="original")
    counted = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return counted.select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold at least 0.8 of the five-word shingles of a benchmark item, or a shorter item whole."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.drop_contaminated(docs, items, short_runs=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    kept = docs.select("doc_id", "lang", "source", "text")
    return bpe.encode(kept, public_tokenizers.path("byte_bpe_50k.json"), decoded=True, keep_text=False)


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", without_near_duplicates),
    ("substrings", without_repeated_passages),
    ("decontamination", without_benchmark),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what one returns is written to the shared folder and read again by the next."""
    docs = on_path(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
