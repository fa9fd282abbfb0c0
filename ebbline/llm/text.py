"""Column expressions on texts that several operators share.

White space is always the six ASCII characters space, tab, line feed, vertical tab, form feed and
carriage return; letter case is folded for A-Z alone. Both are byte-wise rules, so no result depends
on a locale or on a Unicode version.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def plain(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def words(text: Column) -> Column:
    """Runs of other characters than white space, in order; no words in an empty or null text."""
    trimmed = stripped(plain(text))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def packed(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` as one struct, so that added columns cannot clash with its own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
