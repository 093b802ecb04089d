"""Feed ingest: staged files -> contract -> load metadata -> raw table.

The reference downloads a file to the driver, parses it with pandas and
ships the frame to the JVM. Here executors parse the staged files
directly, and the append is the only action.

A load has an id, the partition of both tables that its rows go to. Writing
a load replaces its own partitions and nothing else, so a load that failed
midway is simply run again under its id: rows are neither lost nor doubled.
Without an id each run is a load of its own, which appends, as the reference
does.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.csv import REASONS, check_header, csv_header, header_diff, read_csv_parsed
from .contracts import METADATA_FIELDS, load_contract, save_contract, with_metadata_fields
from .sinks import add_metadata_columns, create_table_if_missing, replace_partitions

#: Partition column of the tables: which load a row came with.
LOAD_ID = "load_id"
REJECT_SCHEMA = StructType([StructField("reasons", StringType()), StructField("raw", StringType()), *METADATA_FIELDS])


def rejects_table(table: str) -> str:
    return f"{table}_rejects"


def ingest_feed(
    spark: SparkSession,
    path: str,
    contract: StructType,
    table: str,
    area: str,
    now=None,
    key: str | None = None,
    location: str | None = None,
    fmt: str = "parquet",
    multi_line: bool = True,
    extra: str | list[str] = "fail",
    missing: str | list[str] = "fail",
    load_id: str | None = None,
) -> DataFrame:
    """Load one feed's files into ``table`` (created from the contract plus
    metadata fields if missing, partitioned by ``load_id``) and return the
    table's contract and metadata columns.

    The feed's header is held against the contract before anything is
    written: columns on one side only raise
    :class:`~staykit.sources.csv.ContractViolation` unless ``extra`` /
    ``missing`` allow them. A row with a value that does not fit its type
    goes, with its reasons and its whole text, to ``<table>_rejects``
    instead; both tables together hold every row of the feed. Rows are
    written under ``load_id`` (default: a new one), rejects first; a second
    run under the same id replaces the first one's rows in both tables.
    """
    check_header(csv_header(spark, path, multi_line), contract, key, extra, missing)
    load = load_id or uuid.uuid4().hex
    rejects = rejects_table(table)
    for name, schema, place in ((table, with_metadata_fields(contract), location), (rejects, REJECT_SCHEMA, location and f"{location}_rejects")):
        create_table_if_missing(spark, name, StructType([*schema.fields, StructField(LOAD_ID, StringType())]), place, fmt, [LOAD_ID])
    # parsed once (a gzip feed parses in one task a file), written twice
    parsed = read_csv_parsed(spark, path, contract, key=key, multi_line=multi_line, extra=extra, missing=missing)
    parsed = add_metadata_columns(parsed, area, now).persist(StorageLevel.DISK_ONLY)
    try:
        bad = parsed.where(F.col(REASONS) != "").select(
            F.col(REASONS).alias("reasons"), F.col("_raw").alias("raw"), *[f.name for f in METADATA_FIELDS])
        replace_partitions(bad, rejects, {LOAD_ID: load})
        good = parsed.where(F.col(REASONS) == "").drop(REASONS, "_raw", *([key] if key else []))
        replace_partitions(good, table, {LOAD_ID: load})
    finally:
        parsed.unpersist()
    return spark.read.table(table).drop(LOAD_ID)


def violation_report(spark: SparkSession, path: str, contract: StructType, key: str | None = None) -> DataFrame:
    """``column_name, status`` (``extra`` / ``missing``) of a feed's header against its contract."""
    more, less = header_diff(csv_header(spark, path), contract, key)
    return spark.createDataFrame(
        [(n, "extra") for n in more] + [(n, "missing") for n in less], "column_name string, status string")


def ingest_with_stored_contract(spark: SparkSession, contract_path: str, contract: StructType,
                                **kwargs) -> DataFrame:
    """Store the contract as JSON, read it back, and ingest against the copy
    read back (the load path the setup + loader notebooks follow)."""
    save_contract(spark, contract, contract_path)
    return ingest_feed(spark, contract=load_contract(spark, contract_path), **kwargs)
