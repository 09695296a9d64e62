"""Documents to training sequences: language, exact copies, near copies, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return rows of
``documents``; the last returns the packed pieces of what is left.

Defined results: a text that is null, blank or without a letter has no language and goes in the first stage; rows of null
doc_id stay unless their text goes; of rows that repeat doc_id and text one stays; ties (equal texts, equal likeness) go
to the least doc_id; very long texts are judged and packed whole; empty tables give empty results; further columns,
whatever their names, pass through all stages but the last, which returns its own columns.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from regwatch.llm import decontam, exact, lang, near, packing
from regwatch.llm.common import shared_dir
from regwatch.llm.queries import vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network finds to be in one of the learned languages; what it is sure of in none goes."""
    return lang.keep_known(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that differs in white space only."""
    return exact.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return near.drop_near_duplicates(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents left in training sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks), ("packed", packed)]

#: SQL can express neither the trained network nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage on documents. Every stage is written in the shared folder and read again; a stage takes
    the place of the last but one, so never more than two are kept."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        path, schema = f"{folder}/{k % 2}", made.schema
        made.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(schema).parquet(path)
    return docs
