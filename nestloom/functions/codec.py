"""Typed attribute encoding: every value wrapped in a tag naming its kind.

``S`` text, ``N`` number (as text), ``BOOL`` boolean, ``L`` list, ``M`` map. Absent attributes stay
absent, which ``to_json`` gives for free because it drops NULL fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def exact_text(c: Column) -> Column:
    """A floating number's shortest exact text without exponent; NULL for NaN and infinity."""
    text = c.cast("string")
    body, power = F.replace(F.split_part(text, F.lit("E"), F.lit(1)), F.lit("-"), F.lit("")), F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    whole = F.split_part(body, F.lit("."), F.lit(1))
    rest = F.nullif(F.split_part(body, F.lit("."), F.lit(2)), F.lit("0"))
    rest = F.coalesce(rest, F.lit(""))
    n = F.length(rest)
    large = F.when(n <= power, F.concat(whole, rest, F.repeat(F.lit("0"), power - n))).otherwise(
        F.concat(whole, F.substring(rest, F.lit(1), power), F.lit("."), F.substring(rest, power + 1, n))
    )
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), whole, rest)
    expanded = F.concat(F.when(F.startswith(text, F.lit("-")), "-").otherwise(""), F.when(power >= 0, large).otherwise(small))
    finite = ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    return F.when(finite, F.when(F.contains(text, F.lit("E")), expanded).otherwise(text))


def typed_value(c: Column, dtype: T.DataType) -> Column:
    """One tagged value; NULL in, NULL out."""
    if isinstance(dtype, T.BooleanType):
        tagged = F.struct(c.alias("BOOL"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType)):
        number = exact_text(c)
        return F.when(number.isNotNull(), F.struct(number.alias("N")))
    elif isinstance(dtype, T.NumericType):
        tagged = F.struct(c.cast("string").alias("N"))
    elif isinstance(dtype, T.ArrayType):
        tagged = F.struct(F.transform(c, lambda e: typed_value(e, dtype.elementType)).alias("L"))
    elif isinstance(dtype, T.StructType):
        tagged = F.struct(
            F.struct(*[typed_value(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]).alias("M")
        )
    else:
        tagged = F.struct(c.cast("string").alias("S"))
    return F.when(c.isNotNull(), tagged)


def to_typed_json(df: DataFrame, name: str = "item", *keep: str) -> DataFrame:
    """Encode each row as one JSON document, next to the columns in ``keep``."""
    fields = [typed_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias(name))


def item_bytes(df: DataFrame) -> Column:
    """Encoded size of a row, for comparison with a size limit."""
    return F.octet_length(F.to_json(F.struct(*df.columns)))
