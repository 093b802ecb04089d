"""Incremental feed ingest with Structured Streaming.

The batch loader appends a whole snapshot each run; when snapshots arrive
as files in a landing folder, a file-stream query does the same append
incrementally: each new file is read once, typed by the contract, stamped
and written to the raw table's folder. The file sink's commit log plus the
checkpoint make the append exactly-once across restarts and lost
executors, which the batch ``append`` (no key, no merge) cannot promise.
``available_now`` drains what has landed and stops, for scheduled runs.

A row with a value that does not fit its type is kept whole, with its
reasons, as the batch loader does. Accepted and rejected rows go to one sink,
partitioned by ``row_status``, so one commit covers both: :func:`accepted`
and :func:`rejected` read the two parts, and together they hold every row of
the files the stream has committed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans.contracts import METADATA_FIELDS
from ..plans.sinks import add_metadata_columns
from ..sources.csv import REASONS, parsed_columns, reader_options, text_schema

#: Partition column of the sink, and its two values.
STATUS, ACCEPTED, REJECTED = "row_status", "accepted", "rejected"


def stream_ingest(
    spark: SparkSession,
    landing: str,
    contract: StructType,
    sink_path: str,
    checkpoint: str,
    area: str,
    now=None,
    key: str | None = None,
    header: list[str] | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    multi_line: bool = True,
):
    """Start the stream; returns the ``StreamingQuery``.

    ``header`` is the files' column list (default: optional ``key`` then the
    contract's fields); each file's header is checked against it.
    """
    names = header or ([key] if key else []) + contract.fieldNames()
    reader = spark.readStream.schema(text_schema(names)).options(**reader_options(multi_line))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.csv(landing).select(*parsed_columns(names, contract, key))
    rows = (rows.drop(key) if key else rows).withColumn(STATUS, F.when(F.col(REASONS) == "", ACCEPTED).otherwise(REJECTED))
    writer = (add_metadata_columns(rows, area, now).writeStream
              .format("parquet").option("path", sink_path).partitionBy(STATUS)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def stream_ingest_once(spark: SparkSession, landing: str, contract: StructType, sink_path: str,
                       checkpoint: str, area: str, now=None, timeout_s: int | None = None,
                       **kwargs) -> DataFrame:
    """Drain the landing folder once and return the accepted rows as a batch frame.

    The stream stops by itself once what has landed is written, however long
    that takes; with ``timeout_s`` it is stopped after that time and an error
    raised (the checkpoint keeps what was committed, so a rerun resumes).
    """
    q = stream_ingest(spark, landing, contract, sink_path, checkpoint, area, now,
                      available_now=True, **kwargs)
    if q.awaitTermination(timeout_s) is False:
        q.stop()
        raise TimeoutError(f"stream over {landing} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return accepted(spark, sink_path)


def accepted(spark: SparkSession, sink_path: str) -> DataFrame:
    """The sink's rows that fit the contract: its fields and the load metadata."""
    return spark.read.parquet(sink_path).where(F.col(STATUS) == ACCEPTED).drop(STATUS, REASONS, "_raw")


def rejected(spark: SparkSession, sink_path: str) -> DataFrame:
    """``reasons, raw`` (the row's text as JSON) and the load metadata of the sink's other rows."""
    return spark.read.parquet(sink_path).where(F.col(STATUS) == REJECTED).select(
        F.col(REASONS).alias("reasons"), F.col("_raw").alias("raw"), *[f.name for f in METADATA_FIELDS])
