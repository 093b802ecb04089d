"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reach_workers
from . import (
    decontam, exact_dedup, html_text, lexical, licenses, packing, periodic, pii, quality, sharding, simhash, suffix_dedup, toxicity,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return suffix_dedup.dedup(docs, length=50, with_text=False).drop("kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return simhash.near_duplicates(docs, shingle=4, most=4).select("doc_id", "fingerprint", "component_id")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op6_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shingle=5, threshold=0.8)


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN, size=1024, end=2)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rules(table(spark, sf_dir, "documents"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.3).select("doc_id", "held_out", "score", "predicted")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, f"{sf_dir}/documents.parquet").drop("file", "row")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def spun(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's input: of one document in ten the words from some place on repeat."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def spun_texts(docs: DataFrame) -> DataFrame:
    """The words of each document as the contract deals them, joined by a space."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [(t or b"").split() for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            texts = [b" ".join(spun(w, i)) for w, i in zip(words, b.column("doc_id").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(texts, pa.large_binary()).cast(pa.large_string())], names=["doc_id", "text"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, "doc_id long, text string")


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.find(spun_texts(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_sharding": op3_sharding,
    "op4_licenses": op4_licenses,
    "op5_pii": op5_pii,
    "op6_decontam": op6_decontam,
    "op7_packing": op7_packing,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_toxicity": op10_toxicity,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_lexical": op12_lexical,
    "op13_periodic": op13_periodic,
}

#: DuckDB SQL for the queries that SQL can express; the others are tested
#: against brute-force versions in tests/llm.
ORACLE: dict[str, str] = {
    "op4_licenses": licenses.ORACLE, "op6_decontam": decontam.ORACLE, "op11_exact_dedup": exact_dedup.ORACLE, "op12_lexical": lexical.ORACLE}
