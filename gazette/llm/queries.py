"""The numbered operators as queries over the shared tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``ORACLE`` holds
DuckDB SQL for those that SQL can express.  Queries use the session's own
settings: they change none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle
from .centroids import cluster_vectors
from .common import read
from .decontaminate import contamination
from .hnsw import nearest_neighbours
from .language import page_languages
from .licences import scan_licences
from .mixing import mix_documents
from .negatives import mined_negatives
from .packing import packed_documents
from .quality import quality_scores
from .shards import shard_documents
from .simhash import near_duplicates
from .suffixes import substring_deduplication
from .toxicity import toxicity_scores


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read(spark, sf_dir, "documents"), 16)


def op2_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read(spark, sf_dir, "documents"))


def op3_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read(spark, sf_dir, "embeddings"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_suffix_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_deduplication(read(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_documents(read(spark, sf_dir, "documents"))


def op9_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op10_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(read(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mined_negatives(read(spark, sf_dir, "embeddings"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(read(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_hilbert_shards, op2_licence_scan, op3_hnsw_neighbours, op4_toxicity, op5_quality_classifier,
        op6_suffix_deduplication, op7_benchmark_decontamination, op8_sainte_lague_mix, op9_simhash_near_duplicates,
        op10_language_evidence, op11_hard_negatives, op12_best_fit_packing, op13_centroid_clusters)
}
ORACLE: dict[str, str] = {k: v for k, v in oracle.SQL.items() if k in QUERIES}
