"""Delimited feed files read against a contract.

The reference fetches one file on the driver and parses it with pandas.
Here the files are staged in shared storage and parsed by executors: each
file (or split, for plain text) is a task. Gzip and ``multiLine`` files
cannot be split, so a large feed should arrive as many files; the reader
never funnels rows through the driver and never reshuffles a scan.

Reading follows pandas' defaults where they change values: every field is
parsed as text first, pandas' missing tokens become null, then values are
cast to the contract type by name, and NaN in floating columns becomes null,
as Arrow does when pandas hands frames to Spark.

Nothing is lost unsaid. A header that differs from the contract is an error
unless the caller opts out column by column or in whole; a value that does
not fit its type is a reason in ``REASONS`` (see ``read_csv_parsed``), so a
loader can set the row aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from ..functions.text import PANDAS_NA_TOKENS, is_floating, nan_to_null, null_tokens

# The reference's CSV dialect (comma, double quote).
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, compression: str | None = "gzip") -> str:
    """Stage a frame as headed CSV files (one per partition), lossless for text:
    quotes doubled, whitespace kept, empty text quoted so it differs from null."""
    w = (df.write.mode("overwrite").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .options(**CSV_OPTIONS))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path


#: Column of :func:`read_csv_parsed`: what did not fit, ``;``-joined, '' if all did.
REASONS = "_reasons"


class ContractViolation(ValueError):
    """A feed's header differs from its contract."""

    def __init__(self, extra: list[str], missing: list[str]):
        self.extra, self.missing = extra, missing
        super().__init__(f"columns not in the contract: {extra}; contract fields not in the feed: {missing}")


def reader_options(multi_line: bool = True, options: dict[str, str] | None = None) -> dict:
    """Options of every CSV read here, batch or stream: the dialect, quoted
    newlines, and each file's header held against the schema."""
    return {**CSV_OPTIONS, "header": True, "enforceSchema": False, "multiLine": multi_line, **(options or {})}


def csv_header(spark: SparkSession, path: str, multi_line: bool = True, options: dict[str, str] | None = None) -> list[str]:
    """Column names from the header record (Spark reads only the first record)."""
    return spark.read.options(**reader_options(multi_line, options)).csv(path).columns


def header_diff(header: list[str], contract: StructType, key: str | None = None) -> tuple[list[str], list[str]]:
    """(columns the contract lacks, contract fields the header lacks)."""
    known = set(contract.fieldNames()) | ({key} if key else set())
    return [n for n in header if n not in known], [n for n in contract.fieldNames() if n not in header]


def check_header(header: list[str], contract: StructType, key: str | None = None,
                 extra: str | list[str] = "fail", missing: str | list[str] = "fail") -> None:
    """Raise :class:`ContractViolation` unless the differences are allowed.

    ``extra`` / ``missing``: ``"fail"``, ``"allow"``, or the allowed names.
    """
    more, less = header_diff(header, contract, key)

    def refused(names, rule):
        return [] if rule == "allow" else names if rule == "fail" else [n for n in names if n not in rule]

    more, less = refused(more, extra), refused(less, missing)
    if more or less:
        raise ContractViolation(more, less)


def read_csv_parsed(
    spark: SparkSession,
    path: str,
    contract: StructType,
    key: str | None = None,
    multi_line: bool = True,
    tokens=PANDAS_NA_TOKENS,
    options: dict[str, str] | None = None,
    extra: str | list[str] = "fail",
    missing: str | list[str] = "fail",
) -> DataFrame:
    """Headed CSV files as the key, the contract's fields, ``REASONS`` and ``_raw``.

    ``_raw`` is the row's text as JSON where there is a reason, else null.
    Contract fields absent from the files (if allowed) are typed nulls;
    allowed extra columns are kept in ``_raw`` of rejected rows only.
    ``multi_line`` keeps quoted newlines inside one field (listing
    descriptions have them) at the cost of file-level splits.
    """
    header = csv_header(spark, path, multi_line, options)
    check_header(header, contract, key, extra, missing)
    raw = spark.read.schema(text_schema(header)).options(**reader_options(multi_line, options)).csv(path)
    return raw.select(*parsed_columns(header, contract, key, tokens))


def read_csv_contract(spark: SparkSession, path: str, contract: StructType, key: str | None = None,
                      drop_key: bool = False, **kwargs) -> DataFrame:
    """Read headed CSV files by name into the contract's fields.

    ``key`` names a leading key column outside the contract (the feeds carry
    a listing id first); it is kept as ``long`` unless ``drop_key``. A value
    that does not fit its type is null here; loaders use
    :func:`read_csv_parsed` and keep such rows apart.
    """
    rows = read_csv_parsed(spark, path, contract, key, **kwargs).drop(REASONS, "_raw")
    return rows.drop(key) if key and drop_key else rows


def text_schema(header: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in header])


def _cast(value: Column, dtype) -> Column:
    """Text to a contract type; integral-valued decimals (``3.0``) are integers."""
    if not isinstance(dtype, LongType):
        return value.try_cast(dtype)
    number = value.try_cast(DecimalType(38, 10))
    return F.coalesce(value.try_cast(dtype), F.when(number == F.floor(number), number.try_cast(dtype)))


def _typed_fields(header, contract, key):
    present = set(header)
    return ([(key, LongType())] if key and key in present else []) + [
        (f.name, f.dataType) for f in contract.fields if f.name in present and not isinstance(f.dataType, StringType)]


def cast_reasons(header: list[str], contract: StructType, key: str | None = None, tokens=PANDAS_NA_TOKENS) -> Column:
    """``<column>_not_<type>`` for each value that does not fit, ``;``-joined."""
    marks = []
    for name, dtype in _typed_fields(header, contract, key):
        value = null_tokens(name, tokens)
        marks.append(F.when(value.isNotNull() & _cast(value, dtype).isNull(), F.lit(f"{name}_not_{dtype.simpleString()}")))
    return F.concat_ws(";", *marks) if marks else F.lit("")


def parsed_columns(header: list[str], contract: StructType, key: str | None = None, tokens=PANDAS_NA_TOKENS) -> list[Column]:
    """From all-text CSV columns: the key, the contract's fields, ``REASONS`` and ``_raw``."""
    reasons = cast_reasons(header, contract, key, tokens)
    return [*contract_columns(header, contract, key, False, tokens), reasons.alias(REASONS),
            F.when(reasons != "", F.to_json(F.struct(*[F.col(n) for n in header]))).alias("_raw")]


def contract_columns(header: list[str], contract: StructType, key: str | None = None,
                     drop_key: bool = False, tokens=PANDAS_NA_TOKENS) -> list[Column]:
    """Projection from all-text CSV columns to the contract's typed fields."""
    present = set(header)
    cols = []
    if key and not drop_key and key in present:
        cols.append(_cast(null_tokens(key, tokens), LongType()).alias(key))
    for f in contract.fields:
        if f.name not in present:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        value = null_tokens(f.name, tokens)
        if not isinstance(f.dataType, StringType):
            value = _cast(value, f.dataType)
            if is_floating(f.dataType):
                value = nan_to_null(value)
        cols.append(value.alias(f.name))
    return cols


def apply_null_tokens(df: DataFrame, tokens=PANDAS_NA_TOKENS) -> DataFrame:
    """S3 on a frame already typed: tokens -> null on text, NaN -> null on floats."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, StringType):
            cols.append(null_tokens(f.name, tokens).alias(f.name))
        elif is_floating(f.dataType):
            cols.append(nan_to_null(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
