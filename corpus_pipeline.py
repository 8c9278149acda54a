"""A corpus pipeline: stages that each take and return documents.

Quality rules, near duplicates, benchmark decontamination, personal data, token ids. Each
stage works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verbaloom.llm import decontamination, jaccard_join, pii, quality_rules, sentencepieces
from verbaloom.llm.common import read_table, vocabulary_path
from verbaloom.llm.queries import PIECE_MODEL, quality_verdicts
from verbaloom.sources.tables import new_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that neither the fixed limits nor the learned rules reject."""
    judged = quality_verdicts(spark, docs, sf_dir)
    return quality_rules.only_kept(judged).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of similar ones."""
    return jaccard_join.one_of_each(docs, threshold=jaccard_join.THRESHOLD)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that do not contain half of a benchmark item or more."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document; every new chunk is checked against the library."""
    made = sentencepieces.encode_texts(docs, vocabulary_path(PIECE_MODEL), decode=True)
    return made.select(
        "doc_id",
        "lang",
        "source",
        F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("personal data", personal_data),
    ("sentencepiece ids", token_ids),
]

# Tilings, transducers and piece agendas are not SQL; a test runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what each stage returns is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
