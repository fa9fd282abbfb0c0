"""Weekly budget rows derived from transactions; a stand-in for a table that is normally given."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ebbline import schemas
from ebbline.options import SeriesOptions


def weekly_budget(
    tx: DataFrame, categories: DataFrame, options: SeriesOptions = SeriesOptions(), look_back: int = 3
) -> DataFrame:
    """Weekly debits per customer; the allocation is the mean of up to ``look_back`` weeks before.

    A customer has at most one row per week, which bounds the window group.
    """
    spending = (
        tx.where(F.col("TransDate").isNotNull() & (F.col("TransType") == options.debit_type))
        .groupBy("CustomerID", F.date_sub(F.next_day("TransDate", "MON"), 7).alias("Week"))
        .agg(F.coalesce(F.sum("TransAmount"), F.lit(0).cast("decimal(28,2)")).alias("Spending"))
    )
    before = W.partitionBy("CustomerID").orderBy("Week").rowsBetween(-look_back, -1)
    allocated = F.sum("Spending").over(before).cast("double") / F.count("Spending").over(before)
    return (
        spending.withColumn("AllocatedAmount", F.when(F.count("Spending").over(before) > 0, allocated))
        .join(categories.select("CustomerID", "CategoryTypeCode"), "CustomerID")
        .select(
            "CustomerID",
            "Week",
            F.coalesce("AllocatedAmount", F.lit(0.0)).alias("AllocatedAmount"),
            "CategoryTypeCode",
            F.col("Spending").cast("double").alias("Spending"),
        )
        .select(schemas.WEEKLY_BUDGET.names)
    )
