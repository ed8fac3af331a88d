"""Corpus pipeline: documents -> packed training sequences.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next one's ``docs``. All but the last return the columns of documents:

1. quality_classifier: documents that score below the classifier's threshold go;
2. ngram_join: one document of each group of near duplicates stays (word
   5-shingles, Jaccard similarity 0.8 or more; the smallest doc_id);
3. secret_scan: reported secrets are masked inside the texts;
4. mixing: documents are sampled to raked source, language and topic shares;
5. packing: documents become pieces placed in bins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cxlake.llm import mixing, ngram_join, packing, pairwise_quality, secret_scan
from cxlake.llm.shared import small_batches, use_checkpoint_dir
from cxlake.llm.text_stats import text_counts

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    ranker = pairwise_quality.train(text_counts(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = pairwise_quality.score_documents(docs, ranker, carry=COLUMNS)
    return scored.where(F.col("score") >= pairwise_quality.THRESHOLD).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs.select(*COLUMNS), SHINGLE_WORDS, SIMILARITY_PERCENT)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sampled_documents(docs.select(*COLUMNS))


def best_fit_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_join", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixed_sources),
    ("packing", best_fit_bins),
]

# A trained classifier and sampling by Spark's hash have no SQL form; tests/llm checks the stages.
ORACLE_SQL = None


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's Parquet goes once the next one is written."""
    use_checkpoint_dir(spark)
    base = f"{spark.sparkContext.getCheckpointDir()}/corpus-pipeline-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        folder = f"{base}/{name}"
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            _remove(spark, before)
        before = folder
    return docs
