"""Scoring flows: the whole population, or requested customers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from ebbline.operators.overrides import default_rules, with_overrides
from ebbline.options import SeriesOptions
from ebbline.plans.datasets import inference_set
from ebbline.schemas import IDENTIFIERS
from ebbline.session import staging
from ebbline.sources.requests import Request
from ebbline.sources.sinks import append_predictions, response_records


def predict(rows: DataFrame, pipeline: PipelineModel) -> DataFrame:
    """Identifiers and the predicted Struggle, 0 or 1."""
    return pipeline.transform(rows).select(*IDENTIFIERS, F.col("prediction").cast("int").alias("Struggle"))


def score(
    flows: DataFrame,
    features: DataFrame,
    pipeline: PipelineModel,
    request: Request = None,
    rules: DataFrame | None = None,
    series: SeriesOptions = SeriesOptions(),
) -> DataFrame:
    """Predictions for next month, one row per eligible series, with the override rules applied."""
    rows = inference_set(flows, features, request, series)
    return with_overrides(predict(rows, pipeline), default_rules(flows.sparkSession) if rules is None else rules)


def score_all(
    flows: DataFrame, features: DataFrame, pipeline: PipelineModel, path: str, run: str | None = None, **options
) -> None:
    """Score everyone and append the predictions to the table at ``path``. Tables staged on the way are deleted.

    ``run`` names the run, such as the month that is scored: repeated, it adds nothing.
    """
    with staging(flows.sparkSession):
        append_predictions(score(flows, features, pipeline, **options), path, run)


def score_customers(
    flows: DataFrame, features: DataFrame, pipeline: PipelineModel, request: Request, **options
) -> DataFrame:
    """JSON records for the requested customers; an empty request scores everyone."""
    return response_records(score(flows, features, pipeline, request, **options))
