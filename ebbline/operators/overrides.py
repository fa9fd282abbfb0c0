"""Output defaults and per-customer override rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline import schemas
from ebbline.operators.features import require_unique
from ebbline.options import DEFAULT_OVERRIDES


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_OVERRIDES, schemas.OVERRIDE_RULES)


def with_overrides(predictions: DataFrame, rules: DataFrame) -> DataFrame:
    """Identifiers, Struggle, StruggleWeek and FundingAmount.

    Week and amount are 0 unless a rule for the customer says otherwise; a rule's null leaves the
    field alone. Catalyst broadcasts the rules when they are small enough by size.
    """
    filled = predictions.select(
        *schemas.IDENTIFIERS,
        F.col("Struggle").cast("int").alias("Struggle"),
        F.lit(0).alias("StruggleWeek"),
        F.lit(0).alias("FundingAmount"),
    )
    fields = ["Struggle", "StruggleWeek", "FundingAmount"]
    rule = require_unique(rules).select("CustomerID", *[F.col(f).alias(f"Rule{f}") for f in fields])
    return filled.join(rule, "CustomerID", "left").select(
        *schemas.IDENTIFIERS, *[F.coalesce(f"Rule{f}", f).alias(f) for f in fields]
    )
