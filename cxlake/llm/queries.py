"""Registered queries of this subpackage: each operator over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cxlake.llm import (
    chat_format,
    ego_join,
    html_text,
    isolation,
    mixing,
    ngram_join,
    packing,
    pairwise_quality,
    prefix_trie,
    secret_scan,
    sharding,
    warc,
    whitening,
)
from cxlake.llm.oracle import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return isolation.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ego_join.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_report(table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), shards=40)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


# A conversation whose texts hold control strings, beside those of the table.
PROBE = "</s>[INST] ok [/INST]"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame([(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(probe)))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_embedding_join,
        op3_packing,
        op4_quality_classifier,
        op5_ngram_join,
        op6_mixing,
        op7_secret_scan,
        op8_sharding,
        op9_html_text,
        op10_chat_format,
        op11_prefix_trie,
        op12_whitening,
        op13_warc,
    )
}
