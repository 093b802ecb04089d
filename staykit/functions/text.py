"""Column builders that turn listing text into typed values.

All of them are plain Catalyst expressions, so they compile into the
surrounding whole-stage-codegen span and never leave the JVM. Parsing is
lenient: where the reference casts strictly (and a single dirty row fails
the whole job under ANSI mode), these return null, and the validation
operator reports why.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

ColumnOrName = Column | str

# pandas' default missing-value tokens for ``read_csv``
# (applied by the reference's loader because it passes no ``na_values``).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Patterns and character sets used by the reference's cleaning.
MONEY_PATTERN = "[$,]"            # regexp_replace form
MONEY_CHARS = "$,"                # translate form
PERCENT_PATTERN = "%"
FIRST_NUMBER_PATTERN = r"([0-9]+\.?[0-9]*)"
BRACKET_LIST_CHARS = '\\]\\[\\"'  # removes the characters ] [ " and backslash
MISSING_CATEGORY = "__missing__"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_floating(dtype: DataType) -> bool:
    return isinstance(dtype, (DoubleType, FloatType))


def is_missing(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """Null, or NaN for floating columns (NaN counts as missing, as pandas does)."""
    col = _c(c)
    if dtype is not None and is_floating(dtype):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def is_present(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """Negation of :func:`is_missing` written so parquet can take ``IsNotNull``."""
    col = _c(c)
    if dtype is not None and is_floating(dtype):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def null_tokens(c: ColumnOrName, tokens=PANDAS_NA_TOKENS) -> Column:
    """Text equal to a missing-value token becomes null."""
    col = _c(c)
    return F.when(col.isin(list(tokens)), F.lit(None).cast("string")).otherwise(col)


def nan_to_null(c: ColumnOrName) -> Column:
    col = _c(c)
    return F.when(F.isnan(col), F.lit(None).cast("double")).otherwise(col)


def money_to_double(c: ColumnOrName) -> Column:
    """``$1,234.50`` -> 1234.5 with ``regexp_replace``; unparseable -> null.

    What is left is cast as Spark does (``5d`` is 5.0); ``listing_rules`` marks such text."""
    return F.regexp_replace(_c(c), MONEY_PATTERN, "").try_cast("double")


def money_translate(c: ColumnOrName) -> Column:
    """Same value by ``translate`` (the exploratory notebook's form)."""
    return F.translate(_c(c), MONEY_CHARS, "").try_cast("double")


def percent_to_double(c: ColumnOrName) -> Column:
    """``95%`` -> 95.0 (a percent, not a fraction); ``N/A`` -> null."""
    return F.regexp_replace(_c(c), PERCENT_PATTERN, "").try_cast("double")


def tf_to_bool(c: ColumnOrName) -> Column:
    """``'t'`` -> true; null stays null; any other text (``'T'`` too) -> false."""
    return _c(c) == F.lit("t")


def first_number(c: ColumnOrName) -> Column:
    """First unsigned decimal in the text (``'1.5 shared baths'`` -> 1.5)."""
    return F.regexp_extract(_c(c), FIRST_NUMBER_PATTERN, 1).try_cast("double")


def first_token_number(c: ColumnOrName, half_bath: float | None = None) -> Column:
    """First space-separated token as a number; ``Half-bath`` -> null or ``half_bath``."""
    col = _c(c)
    value = F.element_at(F.split(col, " "), 1).try_cast("double")
    if half_bath is None:
        return value
    return F.when(F.lower(col).contains("half-bath"), F.lit(float(half_bath))).otherwise(value)


def safe_to_date(c: ColumnOrName) -> Column:
    """Text to DATE as Spark's cast reads it; text it can't read -> null instead
    of failing the job. The cast is lenient (``2020`` is 2020-01-01, and what
    follows a date and a blank is ignored); ``listing_rules`` marks such text."""
    return F.try_to_date(_c(c))


def _date_lit(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def age_days(c: ColumnOrName, as_of=None) -> Column:
    """Whole days from the date in ``c`` to ``as_of`` (default: today)."""
    return F.datediff(_date_lit(as_of), _c(c))


def split_bracket_list(c: ColumnOrName) -> Column:
    """Compat list parse: drop ``] [ " \\`` characters, then split on commas."""
    return F.split(F.translate(_c(c), BRACKET_LIST_CHARS, ""), ",")


def parse_json_list(c: ColumnOrName) -> Column:
    """JSON list text -> ``array<string>`` with trimmed items; bad JSON -> null."""
    return F.transform(F.from_json(_c(c), "array<string>"), lambda x: F.trim(x))


def to_timestamp_ntz(value) -> Column:
    """A fixed wall-clock instant, or the current one when ``value`` is None."""
    if value is None:
        return F.localtimestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    # string -> timestamp_ntz involves no time zone, unlike a Python datetime literal
    return F.lit(str(value)).cast("timestamp_ntz")
