"""Row-level predicates and fills."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def non_negative_flag(balance: Column) -> Column:
    """1 unless the balance is below zero; a null balance counts as 1."""
    return F.when(balance < 0, 0).otherwise(1)


def struggle_flag(balance: Column, previous_mean: Column, drop_ratio: float) -> Column:
    """1 when the balance fell more than ``drop_ratio`` below the previous mean; null mean gives 0.

    The threshold is the mean minus its share, so a negative mean moves it up, not down.
    """
    return F.when(
        balance.cast("double") < previous_mean - F.lit(drop_ratio) * previous_mean, 1
    ).otherwise(0)


def double_literal(value: float) -> str:
    """SQL for exactly this double, infinities included."""
    return f"CAST('{value!r}' AS DOUBLE)"


def missing(value: str) -> str:
    """SQL test of a double for null, NaN or infinity."""
    return f"({value} IS NULL OR isnan({value}) OR abs({value}) = CAST('Infinity' AS DOUBLE))"


def filled(value: str, sentinel: float = -1.0) -> str:
    """SQL for ``value`` with missing values replaced."""
    return f"CASE WHEN {missing(value)} THEN {double_literal(sentinel)} ELSE {value} END"


def epoch_millis(date: Column) -> Column:
    """Milliseconds from 1970-01-01 to the start of ``date``, whatever the session time zone."""
    return F.unix_date(date).cast("bigint") * F.lit(86_400_000).cast("bigint")


def hash_bucket(buckets: int, *parts: Column | str) -> Column:
    """Number in [0, buckets) from the MD5 of the parts joined by '|'; the same on any engine."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
