"""The corpus pipeline: five stages, each written as a table that the next one reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakespark.llm import decontam, language, mixing, neardup, secrets
from lakespark.llm.common import crc_of_id, prepare, table
from lakespark.session import shared_folder

#: Language identification rejects a document whose score is below this, or that has no letter.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents in which the network finds one of the learned languages."""
    model = language.learn(docs, crc_of_id() % 3 != 1)
    # columns of the documents travel in one, so that none can clash with the result's
    found = language.identify(docs.select("text", F.struct(*docs.columns).alias("_row")), model)
    passed = found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE))
    return passed.select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest doc_id of each group of near duplicates (five words, 0.8).

    Rows that agree in doc_id and text are one row; rows of one doc_id with different texts all stay or go
    together. Rows without a doc_id cannot be told apart, and stay.
    """
    found = neardup.near_duplicates(docs, k=5, percent=80).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    named = docs.join(found, docs["doc_id"] == F.col("_id"), "left_semi")
    named = named.withColumn("_digest", F.sha2("text", 256)).dropDuplicates(["doc_id", "_digest"]).drop("_digest")
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that hold no passage of the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, with secrets replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The drawn mixture of the sources: all columns of the documents, the words taken of each, and where its pieces go."""
    mixed = mixing.with_rows(mixing.mix(docs), docs)
    added = ("size", "source_size", "target", "pieces")
    # a document's own column of such a name gives way
    own = (F.col("row").getField(c).alias(c) for c in docs.columns if c not in (*added, "taken"))
    return mixed.select(*own, *added, mixing.taken(mixed).alias("taken"))


STAGES = [
    ("language_id", identify_language),
    ("minmax_neardup", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("secret_scan", redact_secrets),
    ("source_mix", mix_sources),
]

#: Neither the network nor the alignment can be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = table(prepare(spark), sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{n}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
