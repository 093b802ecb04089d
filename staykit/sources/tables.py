"""Readers for the parquet tables under an ``sf_dir``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the scan stays lazy so pruning and pushdown apply."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Expose driver tables to SQL text under their own names.

    A DataFrame built from SQL resolves its views when it is created, so a
    later re-registration (another ``sf_dir``) does not change it.
    """
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
