"""GeoJSON feature collections flattened to one row per feature.

Documents are parsed by executors: either a column of JSON text
(``features_from_docs``) or whole files (``read_geojson``, one document per
file, or one per line). Missing keys give nulls, as the reference's
``dict.get`` does. Text that is not a FeatureCollection is not dropped
silently: ``rejected_docs`` / ``read_geojson_rejects`` return it with a
reason, and ``on_error="fail"`` stops the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_FEATURE = StructType([
    StructField("type", StringType(), True),
    StructField("geometry", StructType([
        StructField("type", StringType(), True),
        StructField("coordinates", StringType(), True),   # kept as raw JSON text
    ]), True),
    StructField("properties", StructType([
        StructField("neighbourhood", StringType(), True),
        StructField("neighbourhood_group", StringType(), True),
    ]), True),
])
COLLECTION_SCHEMA = StructType([
    StructField("type", StringType(), True),
    StructField("features", ArrayType(_FEATURE), True),
])


_KEPT = StructType(COLLECTION_SCHEMA.fields + [StructField("_corrupt", StringType(), True)])
_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _flatten(features: Column, geometry: bool = False) -> list[Column]:
    def feature(f):
        cols = [
            f["properties"]["neighbourhood"].alias("neighbourhood"),
            f["properties"]["neighbourhood_group"].alias("neighbourhood_group"),
            f["geometry"]["type"].alias("geometry_type"),
            f["type"].alias("feature_type"),
        ]
        return F.struct(*cols, f["geometry"]["coordinates"].alias("coordinates")) if geometry else F.struct(*cols)

    return [F.inline_outer(F.transform(features, feature))]


def _reason(fc: Column, text: Column) -> Column:
    """Why a document yields no features, or null."""
    return (F.when(text.isNull(), "no text").when(fc.isNull() | fc["_corrupt"].isNotNull(), "not JSON")
            .when(~fc["type"].eqNullSafe("FeatureCollection"), "not a FeatureCollection")
            .when(fc["features"].isNull(), "no feature list"))


def _checked(df: DataFrame, doc_col: str) -> DataFrame:
    fc = F.from_json(F.col(doc_col), _KEPT, _PARSE)
    return df.select(F.col(doc_col).alias("doc"), fc.alias("fc")).withColumn("reason", _reason(F.col("fc"), F.col("doc")))


def features_from_docs(df: DataFrame, doc_col: str = "doc", on_error: str = "skip", geometry: bool = False) -> DataFrame:
    """``neighbourhood, neighbourhood_group, geometry_type, feature_type`` per feature.

    ``geometry`` adds ``coordinates`` as JSON text, for a boundary layer.
    ``on_error="fail"`` raises at the first document that is not a
    FeatureCollection; the default leaves those to :func:`rejected_docs`.
    """
    checked = _checked(df, doc_col)
    if on_error == "fail":
        checked = checked.where(F.when(F.col("reason").isNotNull(), F.raise_error(F.concat(
            F.lit("GeoJSON document rejected: "), "reason")).cast("boolean")).otherwise(True))
    good = checked.where(F.col("reason").isNull() & (F.size(F.col("fc.features")) > 0))
    return good.select(*_flatten(F.col("fc.features"), geometry))


def rejected_docs(df: DataFrame, doc_col: str = "doc") -> DataFrame:
    """``doc, reason`` of every document that is not a FeatureCollection."""
    return _checked(df, doc_col).where(F.col("reason").isNotNull()).select("doc", "reason")


def read_docs(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``doc``: one (pretty-printed) document per file, one task per file; or one
    per line (JSON Lines), which Spark splits inside large files. Blank lines
    are no documents."""
    return spark.read.text(path, wholetext=multi_line).select(F.col("value").alias("doc")).where(F.trim("doc") != "")


def read_geojson(spark: SparkSession, path: str, multi_line: bool = True, **options) -> DataFrame:
    """Read GeoJSON files and flatten them (options as in :func:`features_from_docs`)."""
    return features_from_docs(read_docs(spark, path, multi_line), **options)


def read_geojson_rejects(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``doc, reason`` of the documents that :func:`read_geojson` leaves out."""
    return rejected_docs(read_docs(spark, path, multi_line))
