"""Corpus pipeline: language, exact copies, near copies, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.llm import chunk_recipes, language_id, packing, secret_forest, simhash_gray
from martkit.llm.common import ensure_checkpoint_dir, fresh, scratch
from martkit.llm.queries import TOKENIZER
from martkit.sources.sinks import discard

#: A document goes if its language is undetermined or its pooled probability is below this. With more than
#: ``CLASSES`` languages the bound falls, so that it stays the same multiple of an even guess.
MIN_SCORE, CLASSES = 0.3, 4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; the network learns from the rows that are not held out.

    Without a labelled row nothing can be learned, and all documents stay.
    """
    model = language_id.fit(docs)
    if not model.langs:
        return docs
    verdict = fresh(docs, "verdict")
    marked = docs.withColumn(verdict, language_id.predict_column(model, F.col("text")))
    least = min(MIN_SCORE, MIN_SCORE * CLASSES / len(model.langs))
    keep = (F.col(verdict)["lang"] != language_id.UNDETERMINED) & (F.col(verdict)["score"] >= least)
    return marked.filter(keep).select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return chunk_recipes.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the smallest id; those without an id come last.

    A document is named by its id and its text's hash, as an id can be missing or stand for several texts.
    Repeated rows share their name; the exact stage leaves none.
    """
    own, row = fresh(docs, "own_id"), fresh(docs, "own_row")
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"),
                    F.xxhash64("text").alias("text_key"))
    found = simhash_gray.near_duplicates(docs.select(name.alias("doc_id"), "text"))
    drop = (found.filter(~F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(own)).distinct())
    # structs, so that a missing id equals a missing id; the text hash in them spreads rows without one
    return docs.withColumn(row, name).join(drop, F.col(row) == F.col(own), "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced."""
    return secret_forest.redact(docs, secret_forest.scan(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their sequence and place."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("language", language), ("exact", exact), ("near", near), ("secrets", secrets), ("pack", pack)]

#: The language network and the forest cannot be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, with files in the shared checkpoint folder between them.

    What a stage stored for itself goes when its result is written, and its input with it.
    """
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            discard(spark, f"{folder}/{before}")
        before = name
    return docs
