"""Most frequent values of columns with very many values.

``top_values`` counts every value. Here values are first counted by a hash of
theirs, a sketch of ``BUCKETS`` numbers a column that tasks add up: no value is
more frequent than its bucket. Then

1. the values of the ``FIRST`` fullest buckets are counted exactly; the k-th
   greatest count is a lower bound for the answer;
2. only values of buckets that reach this bound can belong to the answer too:
   if there are such buckets, their values are counted as well.

So the result equals :func:`.profile.top_values`, whatever the data, and only
the values of full buckets are shuffled. With no frequent values at all (a
column of keys) every bucket reaches the bound, and all are counted, as they
must be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .quantiles import empty_report

#: Numbers of a column's sketch, and the buckets whose values are counted first, for each value asked for.
BUCKETS, FIRST = 1 << 16, 4


def heavy_hitters(df: DataFrame, columns: list[str], k: int = 5, buckets: int = BUCKETS) -> DataFrame:
    """``column_name, value (text), count, rank`` of the ``k`` most frequent values of each column, ties by value, null a value.

    Runs its passes at once.
    """
    if not columns:
        return empty_report(df, "column_name string, value string, count bigint, rank bigint")
    checkpoint_root(df.sparkSession)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(pairs)).withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)).cast("int"))
    sketch = values.groupBy("column_name", "bucket").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    fullest = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "bucket")
    first = sketch.withColumn("_at", F.row_number().over(fullest)).where(F.col("_at") <= FIRST * k)

    def counted(of: DataFrame) -> DataFrame:
        """The k most frequent values of some buckets: the sketch's rows, at most ``buckets`` a column."""
        named = of.select(F.col("column_name").alias("_c"), F.col("bucket").alias("_b"))
        rows = values.join(F.broadcast(named), (F.col("column_name") == F.col("_c")) & (F.col("bucket") == F.col("_b")))
        return _best(rows.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count")), k)

    best = counted(first).checkpoint()
    bound = best.where(F.col("rank") == k).select(F.col("column_name").alias("_c"), F.col("count").alias("least"))
    # fewer than k values so far: any bucket may hold more
    rest = (sketch.withColumn("_at", F.row_number().over(fullest)).where(F.col("_at") > FIRST * k)
            .join(F.broadcast(bound), F.col("column_name") == F.col("_c"), "left").where("least is null or n >= least"))
    if rest.isEmpty():
        return best
    return _best(best.drop("rank").unionByName(counted(rest).drop("rank")), k)


def _best(counts: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("column_name").orderBy(F.col("count").desc(), F.col("value").asc_nulls_first())
    return counts.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)
