"""A corpus pipeline of four stages, each one operator: language ID, near-duplicate removal, mixing, packing.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each stage's rows as Parquet in the shared folder and
rereads them as the next one's documents.  All but the last return the columns of `documents`.

In every stage an empty table gives an empty one, extra columns are carried whatever their names, texts of any length are read whole, and
no row is dropped for a null in a column that the stage does not read.  What each does with odd rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from soundgrid.llm import base, langid, minhash, mixing, packing


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the classifier does not reject.  It learns from all labelled rows of its input, on a bounded sample.

    Texts that are null, empty or without letters go; a null lang is not learned from; repeated rows share a decision; a null doc_id plays no part.
    """
    return langid.keep_identified(docs, langid.fit(docs, held_out_fold=None))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8 or more: that with the least doc_id.

    Texts without words are linked with nothing and stay; of rows that repeat a doc_id one stays; rows without a doc_id stay.
    """
    return minhash.keep_first(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates, at most 1, whose expected domain tokens match the target weights in least squares.

    A text that is null or empty has the labelled rows' shares as posteriors; without labels there is one domain; rows of one doc_id, or of none, are drawn alike.
    """
    return mixing.keep_mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids.

    A null or empty text is the end id alone; repeated rows are packed each; a null doc_id is carried.
    """
    return packing.pack(docs)


STAGES = [("language_id", identify_language), ("near_duplicates", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack_sequences)]

#: The stages hold trained classifiers and tokenizers, which SQL cannot express; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = base.scratch(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
