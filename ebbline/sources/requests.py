"""Restriction of a scan to requested customers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ebbline.functions.casts import NULL_ID, text_id
from ebbline.session import stage

# Up to this many ids go into the filter itself, where they reach the scan.
INLINE_IDS = 1_000
# Longer requests are broadcast up to this size, measured before the join.
BROADCAST_BYTES = 64_000_000
# Room that an id takes besides its text.
ID_BYTES = 32

Request = Sequence[object] | DataFrame | None


@dataclass(frozen=True)
class Asked:
    """A request that has been looked at: short ones are a list, long ones a frame of distinct ids."""

    ids: tuple[str, ...] | DataFrame


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a frame of one text column only when its measured size is at most ``max_bytes``."""
    size = df.agg(F.sum(F.octet_length(df.columns[0]) + ID_BYTES)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def resolve(request: Request | Asked) -> Asked | None:
    """The request, evaluated once; None when it asks for everyone. At most INLINE_IDS + 1 ids are collected."""
    if request is None or isinstance(request, Asked):
        return request
    if isinstance(request, DataFrame):
        ids = request.select(text_id(request.columns[0]).alias("RequestedID")).distinct()
        wanted = sorted(row[0] for row in ids.limit(INLINE_IDS + 1).collect())
        if len(wanted) > INLINE_IDS:
            return Asked(broadcast_if_small(stage(ids, "request")))
    else:
        wanted = sorted({NULL_ID if i is None else str(i) for i in request})
    return Asked(tuple(wanted)) if wanted else None


def _key_in(df: DataFrame, key: str, wanted: Sequence[str]) -> Column:
    """Test of the bare key column, whatever its type, in a form that scans can take over."""
    column = F.col(key)
    dtype = df.schema[key].dataType
    if isinstance(dtype, T.StringType):
        found = column.isin(list(wanted))
    elif isinstance(dtype, T.IntegralType):
        numbers = {i: int(i) for i in wanted if i.removeprefix("-").isdecimal()}
        found = column.isin([F.lit(n).cast(dtype) for i, n in numbers.items() if str(n) == i and _fits(n, dtype)])
    else:
        found = column.cast("string").isin(list(wanted))
    return found | column.isNull() if NULL_ID in wanted else found


def _fits(number: int, dtype: T.IntegralType) -> bool:
    bits = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}[type(dtype)]
    return -(1 << bits - 1) <= number < 1 << bits - 1


def for_customers(df: DataFrame, request: Request | Asked, key: str = "CustomerID") -> DataFrame:
    """Rows of the requested customers. No request, or an empty one, means every customer.

    Only whole customers are removed, so a restricted scan gives the same series as filtering
    the full result. Apply it to a table as read, as the scans do: once null keys have been spelled
    out, the filter no longer reaches the files.
    """
    asked = resolve(request)
    if asked is None:
        return df
    ids = asked.ids
    if isinstance(ids, tuple):
        if len(ids) <= INLINE_IDS:
            return df.where(_key_in(df, key, ids))
        ids = broadcast_if_small(df.sparkSession.createDataFrame([(i,) for i in ids], "RequestedID string"))
    return df.join(ids, text_id(key) == F.col("RequestedID"), "left_semi")
