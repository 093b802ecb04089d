"""Profiles that are kept with each load and merged.

A load's state is one row a column: counts, mean and sum of squared
deviations, least and greatest value, a HyperLogLog sketch of the values and
a KLL sketch of the numbers. States of any loads merge into the state of their
union, so the profile of a growing table needs no second look at old loads.
Counts, extremes and means are exact; distinct counts and quartiles keep their
sketches' bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_missing
from .profile import QUARTILES, _numeric, _round, _value
from .quantiles import FAN_IN, SKETCH_K, _present, empty_report

#: Bits of the distinct-value sketch: a standard error of 0.8 %.
HLL_BITS = 14
_STATE = ("column_name string, data_type string, n_rows bigint, missing_count bigint, zero_count bigint, n bigint, mean double, m2 double, "
          "min double, max double, distinct_sketch binary, quantile_sketch binary")


def profile_state(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The state of a frame: one row a column, from one pass over the rows.

    Sketches are built on two levels, so no task reads every task's sketch.
    """
    columns = df.columns if columns is None else columns
    if not columns:
        return empty_report(df, _STATE)
    none = F.lit(None).cast("double")
    part = F.pmod(F.spark_partition_id(), F.lit(FAN_IN))
    aggs, structs = [F.count(F.lit(1)).alias("_rows")], []
    for i, c in enumerate(columns):
        num = _numeric(df, c)
        v = _present(df, c) if num else none
        aggs += [F.count_if(is_missing(c, df.schema[c].dataType)).alias(f"m{i}"),
                 F.hll_sketch_agg(F.coalesce(_value(df, c).cast("string"), F.lit(None).cast("string")), HLL_BITS).alias(f"d{i}")]
        if num:
            aggs += [F.count_if(v == 0).alias(f"z{i}"), F.count(v).alias(f"n{i}"), F.avg(v).alias(f"a{i}"), F.var_pop(v).alias(f"v{i}"),
                     F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.kll_sketch_agg_double(v, SKETCH_K).alias(f"q{i}")]
        long = F.lit(None).cast("long")
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("data_type"), F.col("_rows").alias("n_rows"),
            F.col(f"m{i}").alias("missing_count"), (F.col(f"z{i}") if num else long).alias("zero_count"), (F.col(f"n{i}") if num else long).alias("n"),
            (F.col(f"a{i}") if num else none).alias("mean"), (F.col(f"v{i}") * F.col(f"n{i}") if num else none).alias("m2"),
            (F.col(f"lo{i}") if num else none).alias("min"), (F.col(f"hi{i}") if num else none).alias("max"), F.col(f"d{i}").alias("distinct_sketch"),
            (F.col(f"q{i}") if num else F.lit(None).cast("binary")).alias("quantile_sketch")))
    return merge_states(df.groupBy(part.alias("_part")).agg(*aggs).select(F.inline(F.array(*structs))))


def merge_states(states: DataFrame) -> DataFrame:
    """One state from the rows of several: those of the union of their loads."""
    w = Window.partitionBy("column_name")
    mean = F.sum(F.col("n") * F.col("mean")).over(w) / F.nullif(F.sum("n").over(w), F.lit(0))
    moved = states.withColumn("_mean", mean).withColumn("m2", F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2)))
    return moved.groupBy("column_name", "data_type").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("missing_count").alias("missing_count"), F.sum("zero_count").alias("zero_count"), F.sum("n").alias("n"),
        F.max("_mean").alias("mean"), F.sum("m2").alias("m2"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.hll_union_agg("distinct_sketch", True).alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch", SKETCH_K).alias("quantile_sketch"))


def state_report(state: DataFrame, digits: int | None = None) -> DataFrame:
    """``column_name, data_type, n_rows, missing_count, missing_percent, distinct_count, zero_count, mean, stddev, min, max, p25, p50, p75``."""
    quartiles = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(p))).alias(f"p{int(p * 100)}") for p in QUARTILES]
    return state.select(
        "column_name", "data_type", "n_rows", "missing_count", (F.col("missing_count") / F.nullif("n_rows", F.lit(0)) * 100).alias("missing_percent"),
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"), "zero_count", _round(F.col("mean"), digits).alias("mean"),
        _round(F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))), digits).alias("stddev"), "min", "max", *quartiles)


def save_state(df: DataFrame, folder: str, load_id: str) -> None:
    """Keep a load's state under ``folder``; a second call for the load replaces it."""
    profile_state(df).write.mode("overwrite").parquet(f"{folder}/load_id={load_id}")


def read_states(spark, folder: str) -> DataFrame:
    """The state of all loads kept under ``folder``, merged."""
    return merge_states(spark.read.parquet(folder).drop("load_id"))
