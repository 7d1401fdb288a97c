"""From raw documents to sharded training rows in five stages.

Each stage calls one operator, gets all documents that the stage before kept,
and returns the columns of ``documents`` (the last: the place of each document
in the shards).  ``run`` writes what a stage returns as Parquet in the shared
folder and reads it again as the next one's documents, so a lost executor costs
a stage at most.

* ``language_id`` drops documents whose language cannot be told;
* ``near_duplicates`` keeps one document of each SimHash component;
* ``decontaminate`` cuts benchmark passages out, and drops documents made of
  them;
* ``mix`` takes from each source towards its target weight: documents can
  appear once more, or in part;
* ``shard`` places the rows on a Hilbert curve and cuts it into 16 shards.

An empty table passes through all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gazette.llm.common import materialize, read
from gazette.llm.decontaminate import decontaminated
from gazette.llm.language import identified
from gazette.llm.mixing import mixed_rows
from gazette.llm.shards import shard_documents
from gazette.llm.simhash import deduplicated


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# SimHash components are not expressible in SQL: tests check the stages by themselves and their chain.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
