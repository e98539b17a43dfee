"""Typed access to loosely typed input fields.

Raw feed records arrive either as typed columns (string, numeric,
timestamp) or as VARIANT values parsed from JSON. The accessors below
return plain Spark columns whatever the input type is, choosing the
expression once at plan time from the DataFrame schema. No Python runs per
row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of input column.
ABSENT, STRING, NUMERIC, BOOLEAN, VARIANT, TIMESTAMP, ARRAY, OTHER = (
    "absent", "string", "numeric", "boolean", "variant", "timestamp", "array", "other")


def kind(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        return ABSENT
    t = df.schema[name].dataType
    if isinstance(t, T.StringType):
        return STRING
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                      T.FloatType, T.DoubleType, T.DecimalType)):
        return NUMERIC
    if isinstance(t, T.BooleanType):
        return BOOLEAN
    if isinstance(t, T.VariantType):
        return VARIANT
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TIMESTAMP
    if isinstance(t, T.ArrayType):
        return ARRAY
    return OTHER


_NUMBER_TYPE = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)"
_INT_TEXT = r"^\s*[+-]?[0-9]+(_[0-9]+)*(\.0*)?\s*$"


def raw(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None)


def present(df: DataFrame, name: str) -> Column:
    """The field exists and is not (JSON) null."""
    k = kind(df, name)
    if k == ABSENT:
        return F.lit(False)
    if k == VARIANT:
        return F.col(name).isNotNull() & ~F.is_variant_null(F.col(name))
    return F.col(name).isNotNull()


def json_null(df: DataFrame, name: str) -> Column:
    """The field was given as JSON null (an absent field was not given)."""
    if kind(df, name) == VARIANT:
        return F.col(name).isNotNull() & F.is_variant_null(F.col(name))
    return F.lit(False)


def variant_type(c: Column) -> Column:
    """'BIGINT', 'STRING', 'DECIMAL(3,1)', 'ARRAY<...>', 'OBJECT<...>', 'VOID'..."""
    return F.schema_of_variant(c)


# Numeric text: digits with single underscores between them, fraction, exponent, or a named value.
_DIGITS = r"[0-9]+(_[0-9]+)*"
_NUMBER_TEXT = rf"(?i)^\s*[+-]?(({_DIGITS}(\.({_DIGITS})?)?|\.{_DIGITS})(e[+-]?{_DIGITS})?|inf|infinity|nan)\s*$"


def _text_double(c: Column) -> Column:
    return F.when(c.rlike(_NUMBER_TEXT), F.replace(F.trim(c), F.lit("_"), F.lit("")).try_cast("double"))


def _text_long(c: Column) -> Column:
    plain = F.regexp_replace(F.replace(F.trim(c), F.lit("_"), F.lit("")), r"\.0*$", "")
    return F.when(c.rlike(_INT_TEXT), plain.try_cast("long"))


def as_double(df: DataFrame, name: str) -> Column:
    """Number or numeric text as double; NULL when absent or not a number."""
    k = kind(df, name)
    c = raw(df, name)
    if k == STRING:
        return _text_double(c)
    if k == NUMERIC:
        return c.cast("double")
    if k == VARIANT:
        t = variant_type(c)
        return (F.when(t == "STRING", _text_double(F.try_variant_get(c, "$", "string")))
                .when(t.rlike(_NUMBER_TYPE), F.try_variant_get(c, "$", "double")))
    return F.lit(None).cast("double")




def as_long(df: DataFrame, name: str) -> Column:
    """Integer, integral number or integer text (``'12'``, ``' 12 '``, ``'12.0'``)."""
    k = kind(df, name)
    c = raw(df, name)
    if k == STRING:
        return _text_long(c)
    if k == NUMERIC:
        d = c.cast("double")
        # NaN equals NaN in Spark and inf equals floor(inf): exclude both, and
        # try_cast so an out-of-range value is NULL (rejected), not an error.
        return F.when(~F.isnan(d) & (d == F.floor(d)), c.try_cast("long"))
    if k == VARIANT:
        t = variant_type(c)
        d = F.try_variant_get(c, "$", "double")
        # An integer is read as one: through a double, ids above 2^53 would change.
        return (F.when(t == "STRING", _text_long(F.try_variant_get(c, "$", "string")))
                .when(t.rlike("^(BIGINT|INT|SMALLINT|TINYINT)"), F.try_variant_get(c, "$", "bigint"))
                .when(t.rlike(_NUMBER_TYPE) & ~F.isnan(d) & (d == F.floor(d)), d.try_cast("long")))
    return F.lit(None).cast("long")


def as_string(df: DataFrame, name: str) -> Column:
    """The field when it is a JSON/SQL string; NULL for other types."""
    k = kind(df, name)
    c = raw(df, name)
    if k == STRING:
        return c
    if k == VARIANT:
        return F.when(variant_type(c) == "STRING", F.try_variant_get(c, "$", "string"))
    return F.lit(None).cast("string")


def is_string(df: DataFrame, name: str) -> Column:
    k = kind(df, name)
    if k == STRING:
        return F.col(name).isNotNull()
    if k == VARIANT:
        return F.coalesce(variant_type(F.col(name)) == "STRING", F.lit(False))
    return F.lit(False)


# ISO-8601 text begins with a date; a time alone would be read as today's.
_DATE_TEXT = r"^\s*[+-]?[0-9]{4,6}-[0-9]{1,2}-[0-9]{1,2}"
# Fixed value: epoch numbers beyond this are milliseconds, below it seconds.
EPOCH_SECONDS_LIMIT = 2e10


def _text_timestamp(c: Column) -> Column:
    return F.when(c.rlike(_DATE_TEXT), F.try_to_timestamp(c))


def _epoch_timestamp(d: Column) -> Column:
    seconds = F.when(F.abs(d) > EPOCH_SECONDS_LIMIT, d / 1000).otherwise(d)
    return F.when(~F.isnan(d) & (F.abs(seconds) < 1e11), F.timestamp_micros(F.round(seconds * 1e6).cast("long")))


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Timestamp column, ISO-8601 text (``Z``/offset/micros) parsed in UTC, or an epoch number."""
    k = kind(df, name)
    c = raw(df, name)
    if k == TIMESTAMP:
        return c
    if k == STRING:
        return _text_timestamp(c)
    if k == NUMERIC:
        return _epoch_timestamp(c.cast("double"))
    if k == VARIANT:
        t = variant_type(c)
        return (F.when(t == "STRING", _text_timestamp(F.try_variant_get(c, "$", "string")))
                .when(t.rlike(_NUMBER_TYPE), _epoch_timestamp(F.try_variant_get(c, "$", "double"))))
    return F.lit(None).cast("timestamp")
