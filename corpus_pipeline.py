"""Corpus pipeline: documents to training sequences.

STAGES lists the stages in order. Each function takes (spark, docs, sf_dir)
and returns a DataFrame, which :func:`run` writes as Parquet in the shared
folder and rereads as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from staykit.llm import decontam, pii, simhash, toxicity
from staykit.llm.queries import packed, table
from staykit.session import reach_workers, shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts."""
    names = docs.columns
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.3).where("predicted = 0").select(*names)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    reach_workers(spark)
    return simhash.keep_one(docs, shingle=4, most=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing terms generalised."""
    reach_workers(spark)
    return pii.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in sequences of at most 1024."""
    reach_workers(spark)
    return packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", sanitise),
    ("packing", pack),
]

#: SQL can't express the SimHash components, the model or the packing; tests/llm
#: holds run() against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread."""
    docs = table(spark, sf_dir, "documents")
    home = shared_path(spark, "pipeline", unique=True)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{home}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
