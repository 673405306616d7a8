"""From collected documents to shards of a training mix, in five stages.

Each stage takes what the one before it kept. All but the last return the
columns of ``documents``; the last returns the shard and slot of every row that
the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm import jaccard_join, language, mixing, phrase_index, shards
from parcelflow.llm.words import free_name
from parcelflow.operators.joins import BROADCAST_BYTES
from parcelflow.sources import discard, fresh_dir, keep, scope, stage

SHARDS = 16

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told from their text; their declared one is no input.

    Rejected are texts without letters, texts that the network scores lower than almost all of their
    likeliest language, and texts that are not like those of that language, or not like those of any
    that documents are labelled with.
    """
    network, familiar = language.learn(docs), language.learn_familiar(docs)
    keyed = docs.select(_key().alias("doc_id"), "text", "lang")
    told = keep(language.identify(keyed, network, familiar, also=["lang"]), "told")
    strange = language.doubtful(told) | language.unfamiliar(told, familiar)
    gone = told.where((F.col("lang_pred") == language.UNKNOWN) | strange)
    return _without(docs, gone.select("doc_id"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one with the smallest id.

    Near copies have a similarity of 0.8 or more of their sets of runs of five words.
    """
    return jaccard_join.first_of_each(docs, jaccard_join.Similarity(words=5, percent=80))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark stands."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    keyed = docs.select(_key().alias("doc_id"), "text")
    found = phrase_index.phrase_matches(keyed, items, length=10)
    return _without(docs, found.select("doc_id"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the shares of their sources, each as often as the mix takes it."""
    return mixing.mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; equal texts share a shard."""
    return shards.assign_shards(docs, SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_copies", one_of_each_group),
    ("benchmark", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", sharded),
]

# The trained network and the schedule of shards cannot be told in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next.

    Of what is written, only the result is there at the end.
    """
    docs, base, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), fresh_dir(spark, "pipeline"), None
    for name, stage_of in STAGES:
        with scope(spark, name):
            docs = keep(stage_of(spark, docs, sf_dir), name, base=base)
        if before is not None:
            discard(spark, f"{base}/{before}")
        before = name
    return docs


def _key() -> Column:
    """A number for the id and the text of a row; rows that repeat both share it."""
    return F.xxhash64("doc_id", "text")


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in the one column of ``gone``."""
    key, rejected = free_name(docs, "__key"), free_name(docs, "__rejected")
    known = stage(gone.toDF(rejected).distinct(), "rejected")
    side = F.broadcast(known.df) if known.bytes <= BROADCAST_BYTES else known.df
    keyed = docs.withColumn(key, _key())
    return keyed.join(side, F.col(key) == F.col(rejected), "left_anti").drop(key)
