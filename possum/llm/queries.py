"""One registered query per operator, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .collocations import collocations
from .common import shuffle_partitions, table
from .exact_dedup import exact_dedup
from .fingerprints import fingerprints
from .licences import scan_licences
from .merge_dropout import encode
from .near_join import near_copies
from .packing import pack
from .quality import classify
from .secrets import find_secrets
from .sharding import shard_documents
from .training_order import training_order
from .urls import judge
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order(table(spark, sf_dir, "documents"))


def op2_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = max(64, shuffle_partitions(spark))
    return exact_dedup(table(spark, sf_dir, "documents"), buckets=buckets)


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "n_copies")


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).withColumn(
        "expressions", F.array_join("expressions", "; "))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_training_order": op1_training_order,
    "op2_merge_dropout": op2_merge_dropout,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op5_url_filter": op5_url_filter,
    "op6_secret_scan": op6_secret_scan,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_extendible_sharding": op10_extendible_sharding,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_licence_scan": op12_licence_scan,
    "op13_phrase_collocations": op13_phrase_collocations,
}
