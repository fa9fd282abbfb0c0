"""Transactions summed by day, month and customer.

Daily flows are worth storing when series and features are both wanted: they replace the second pass
over the transactions. Every function here takes either transactions or daily flows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ebbline.operators.blocks import CUSTOMER, PRODUCT
from ebbline.options import SeriesOptions

DEFAULTS = SeriesOptions()
SIDES = ("Credit", "Debit")
TOTAL = "decimal(28,2)"
# The columns by which daily flows are told from transactions.
DAILY = ["Day", *[f"{side}{what}" for side in SIDES for what in ("Sum", "Count")]]


def as_flows(tx: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Transactions in the shape of daily flows, one row each; daily flows as they are.

    Undated rows and rows of an unexpected type are left out, and so are rows without a customer or
    product where the scan was told not to spell those out. Null amounts add nothing.
    """
    if set(DAILY) <= set(tx.columns):
        return tx
    cells: list[Column] = []
    for side, kind in zip(SIDES, (options.credit_type, options.debit_type), strict=True):
        amount = F.when(F.col("TransType") == kind, F.col("TransAmount"))
        cells += [amount.alias(f"{side}Sum"), amount.isNotNull().cast("int").alias(f"{side}Count")]
    known = F.col("TransType").isin(options.credit_type, options.debit_type)
    keyed = F.col(CUSTOMER).isNotNull() & F.col(PRODUCT).isNotNull()
    return tx.where(keyed & F.col("TransDate").isNotNull() & known).select(CUSTOMER, PRODUCT, F.to_date("TransDate").alias("Day"), *cells)


def _summed(flows: DataFrame, *keys: Column | str) -> DataFrame:
    return flows.groupBy(*keys).agg(
        *[F.expr(f"CAST(sum({side}Sum) AS {TOTAL}) AS {side}Sum") for side in SIDES],
        *[F.expr(f"sum({side}Count) AS {side}Count") for side in SIDES],
    )


def daily_flows(tx: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Total and count of credits and debits per customer, product and day."""
    return _summed(as_flows(tx, options), CUSTOMER, PRODUCT, "Day")


def customer_days(flows: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """The same per customer and day."""
    return _summed(as_flows(flows, options), CUSTOMER, "Day")


def monthly_flows(flows: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Credit and Debit per customer, product and month, the month given by its last day.

    A month with only one of the two has 0 for the other.
    """
    return (
        as_flows(flows, options)
        .groupBy(CUSTOMER, PRODUCT, F.last_day("Day").alias("Date"))
        .agg(*[F.expr(f"CAST(coalesce(sum({side}Sum), 0) AS {TOTAL}) AS {side}") for side in SIDES])
    )


def detect_types(tx: DataFrame) -> tuple[str, str]:
    """Credit and debit types taken by position: the only two types of the data, in order.

    For sources whose spelling is not known beforehand. Any other number of types is an error.
    """
    # Three rows at most reach the driver, enough to tell two from more.
    found = sorted(row[0] for row in tx.select("TransType").distinct().limit(3).collect())
    if len(found) != 2:
        raise ValueError(f"expected two transaction types, found {found}")
    return found[0], found[1]


def unexpected_types(tx: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Transactions whose type is neither credit nor debit; the flows leave them out."""
    return tx.where(~F.col("TransType").isin(options.credit_type, options.debit_type))
