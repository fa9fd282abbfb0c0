"""Writers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline import schemas
from ebbline.functions.cells import epoch_millis
from ebbline.sources import commits


def by_date(predictions: DataFrame) -> DataFrame:
    """CustomerID, Date and Struggle, brought together by date for writing.

    Most predictions of a run share one date. The rebalance hint gathers rows into few files per date
    and lets adaptive execution split a date that is too big for one task.
    """
    return predictions.select(schemas.PREDICTIONS_SINK.names).hint("rebalance", "Date")


def append_predictions(predictions: DataFrame, path: str, run: str | None = None) -> None:
    """Append to a committed table partitioned by Date; a ``run`` that is in it already changes nothing."""
    commits.write_table(by_date(predictions), path, run, partition_by=["Date"])


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_table(spark, path, schemas.PREDICTIONS_SINK)


def append_training_log(
    spark: SparkSession, path: str, model_name: str, training_date: dt.date, score: float, run: str | None = None
) -> None:
    """Append one row to a committed table; a ``run`` that is in it already changes nothing."""
    row = spark.createDataFrame([(model_name, training_date, float(score))], schemas.TRAINING_LOG)
    commits.write_table(row.coalesce(1), path, run)


def read_training_log(spark: SparkSession, path: str) -> DataFrame:
    return commits.read_table(spark, path, schemas.TRAINING_LOG)


def reload_weekly_budget(rows: DataFrame, path: str, run: str | None = None) -> None:
    """Replace the whole table in one step: until then, and if the job fails, the old rows are read.

    ``rows`` may be read from the table itself.
    """
    commits.write_table(rows.select(schemas.WEEKLY_BUDGET.names), path, run, keep=False)


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append by batched inserts, one connection per partition."""
    df.write.mode("append").jdbc(url, table, properties=dict(properties))


def reload_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Empty the table, keeping its definition, and insert ``df``."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=dict(properties))


def response_fields(predictions: DataFrame) -> DataFrame:
    """Response columns: a prediction without its product, the date in epoch milliseconds."""
    return predictions.select(
        [
            epoch_millis(F.col(c)).alias(c) if c == "Date" else F.col(c)
            for c in predictions.columns
            if c != "ProductCode"
        ]
    )


def response_records(predictions: DataFrame) -> DataFrame:
    """One JSON object per prediction, nulls included."""
    fields = response_fields(predictions)
    return fields.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))


def write_response(predictions: DataFrame, path: str) -> None:
    response_fields(predictions).write.mode("overwrite").option("ignoreNullFields", False).json(path)
