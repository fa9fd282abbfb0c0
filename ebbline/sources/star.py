"""Mapping of the star-schema tables (orders, lineitem, customer) onto the input tables.

These definitions only make the test tables usable as input; they are no part of the engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ebbline import schemas
from ebbline.sources import readers
from ebbline.sources.requests import Request, for_customers

# Market segments in alphabetical order; SegmentID is the place in this list.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# Given so that a scan need not open files to find its columns.
COLUMNS = {
    "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_returnflag string, l_linestatus string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.StructType.fromDDL(COLUMNS[name])
    return readers.Source(path=f"{sf_dir}/{name}.parquet", schema=schema).load(spark)


def transactions(
    spark: SparkSession, sf_dir: str, trans_type: Column | None = None, request: Request = None
) -> DataFrame:
    """One transaction per line item, dated by its order; returned items are debits."""
    if trans_type is None:
        trans_type = F.when(F.col("l_returnflag") == "R", "D").otherwise("C")
    lines = table(spark, sf_dir, "lineitem")
    orders = for_customers(table(spark, sf_dir, "orders"), request, "o_custkey")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").alias("CustomerID"),
        F.col("l_linestatus").alias("ProductCode"),
        F.col("l_extendedprice").alias("TransAmount"),
        F.col("o_orderdate").alias("TransDate"),
        trans_type.alias("TransType"),
    )
    return readers.coerce_transactions(joined)


def order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer per order, each of which has a few transactions."""
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("CustomerID"))


def profiles(spark: SparkSession, sf_dir: str, request: Request = None) -> DataFrame:
    """CustomerID, Age, SegmentID and the segment name as CategoryTypeCode."""
    segment = F.coalesce(
        *[F.when(F.col("c_mktsegment") == name, i + 1) for i, name in enumerate(SEGMENTS)]
    )
    return for_customers(table(spark, sf_dir, "customer"), request, "c_custkey").select(
        F.col("c_custkey").cast("string").alias("CustomerID"),
        (F.col("c_custkey") % 60 + 18).cast("double").alias("Age"),
        segment.cast("int").alias("SegmentID"),
        F.col("c_mktsegment").alias("CategoryTypeCode"),
    )


def budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("BudgetID"),
        F.col("c_custkey").cast("string").alias("CustomerID"),
        F.col("c_mktsegment").alias("CategoryTypeCode"),
        F.col("c_acctbal").alias("AllocatedAmount"),
    )
    return rows.select(schemas.BUDGETS.names)


def budget_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("BudgetID"),
        F.col("o_totalprice").alias("TransAmount"),
        F.col("o_orderdate").alias("TransDate"),
        F.date_format("o_orderdate", "yyyyMM").alias("CalendarYearMonth"),
    )


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_mktsegment").alias("CategoryTypeCode"))
        .distinct()
        .withColumn("CategoryTypeName", F.initcap("CategoryTypeCode"))
    )
