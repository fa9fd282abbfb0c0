"""Type coercion that raises on bad values instead of turning them into nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

NULL_ID = "None"


def strict_cast(df: DataFrame, name: str, dtype: T.DataType) -> Column:
    """``name`` as ``dtype``; a non-null value that does not convert, or not without loss, fails the job.

    Digits that ``dtype`` has no room for are a loss; the last bits of a binary number are not. NaN is
    the missing value of float columns, so it becomes null.
    """
    source = df.schema[name].dataType
    column = F.col(f"`{name}`")
    if isinstance(source, (T.FloatType, T.DoubleType)):
        column = F.when(~F.isnan(column), column)
    if source == dtype:
        return column.alias(name)
    converted = column.try_cast(dtype)
    message = F.concat(F.lit(f"{name}: cannot read as {dtype.simpleString()}: "), column.cast("string"))
    failed = column.isNotNull() & (converted.isNull() | _cut(column, source, converted, dtype))
    return F.when(failed, F.raise_error(message).cast(dtype)).otherwise(converted).alias(name)


def _cut(column: Column, source: T.DataType, converted: Column, dtype: T.DataType) -> Column:
    """Whether digits were lost between a number, or its text, and a whole number or decimal."""
    if not isinstance(dtype, (T.DecimalType, T.IntegralType)) or isinstance(source, T.IntegralType):
        return F.lit(False)
    if isinstance(source, T.DecimalType):
        return column != converted
    if isinstance(source, T.StringType):
        # Text is compared digit by digit, as far as decimals reach; beyond that, as a double.
        exact = column.try_cast(T.DecimalType(38, 12))
        scale = dtype.scale if isinstance(dtype, T.DecimalType) else 0
        wide = converted.cast(T.DecimalType(38, max(12, scale)))
        return F.coalesce(exact != wide, F.lit(False)) | _far(column.try_cast("double"), converted)
    if isinstance(source, (T.FloatType, T.DoubleType)):
        return _far(column.cast("double"), converted, 1e-6 if isinstance(source, T.FloatType) else 1e-12)
    return F.lit(False)


def _far(value: Column, converted: Column, share: float = 1e-12) -> Column:
    """Further apart than the error of writing the number in binary."""
    apart = F.abs(value - converted.cast("double"))
    return F.coalesce(apart > F.greatest(F.abs(value) * share, F.lit(1e-12)), F.lit(False))


def text_id(name: str, null_id_as_text: bool = True) -> Column:
    """Key column as text. A null key is a key of its own, spelled 'None', unless switched off."""
    text = F.col(name).cast("string")
    return (F.coalesce(text, F.lit(NULL_ID)) if null_id_as_text else text).alias(name)
