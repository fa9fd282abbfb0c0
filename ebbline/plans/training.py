"""Training flow."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from ebbline.operators.metrics import classification_metrics
from ebbline.operators.scaling import RobustScale
from ebbline.operators.split import assign_fold, assign_split, assign_stratified_fold, assign_stratified_split
from ebbline.options import ModelOptions, SeriesOptions, SplitOptions
from ebbline.plans.datasets import training_set
from ebbline.plans.model import FittedModel, assembler, fit_model, prepare_stage, save_model
from ebbline.schemas import MODEL_FEATURES, TARGET
from ebbline.session import stage, staging
from ebbline.sources.sinks import append_training_log


def prepare_rows(flows: DataFrame, features: DataFrame, series: SeriesOptions, split: SplitOptions) -> DataFrame:
    """Training set with its split and fold, written once: fitting reads it many times."""
    return split_rows(stage(training_set(flows, features, series), "training"), split)


def split_rows(rows: DataFrame, split: SplitOptions) -> DataFrame:
    """Stored rows with their split, and the folds of the train part."""
    if not split.exact:
        return assign_fold(assign_split(rows, split), split)
    return assign_stratified_fold(assign_stratified_split(rows, options=split), options=split, rows="split = 'train'")


def train_on(rows: DataFrame, model: ModelOptions, split: SplitOptions) -> FittedModel:
    """Fit on the train part of prepared rows.

    The scaler sees the train part only, and training and scoring use the same scaled values. With
    ``reference_compat`` it is fitted on all rows and applied to scoring alone.
    """
    train = rows.where("split = 'train'")
    scale = RobustScale.fit(rows if model.reference_compat else train, MODEL_FEATURES)
    return fit_model(train, scale, model, split)


def evaluate(model: FittedModel, rows: DataFrame, compat: bool = False) -> DataFrame:
    """Accuracy and F1 on the test part of prepared rows.

    With ``compat`` the trees see raw values here too, as they did in training.
    """
    test = rows.where("split = 'test'")
    if compat:
        raw = assembler().transform(prepare_stage(None).transform(test))  # boosting reads its columns as they are
        scored = model.pipeline.stages[-1].transform(raw)
    else:
        scored = model.pipeline.transform(test)
    return classification_metrics(scored, TARGET)


def train(
    flows: DataFrame,
    features: DataFrame,
    series: SeriesOptions = SeriesOptions(),
    split: SplitOptions = SplitOptions(),
    model: ModelOptions = ModelOptions(),
    path: str | None = None,
    log_path: str | None = None,
    training_date: dt.date | None = None,
    model_name: str = "struggle",
    run: str | None = None,
) -> tuple[FittedModel, DataFrame]:
    """Scan results to fitted model and its metrics; stores and logs them where paths are given.

    The metrics are one row, computed here; tables staged on the way are deleted. A ``run`` that is named is
    stored and logged once, however often it is repeated.
    """
    spark = flows.sparkSession
    with staging(spark):
        rows = prepare_rows(flows, features, series, split)
        fitted = train_on(rows, model, split)
        scores = evaluate(fitted, rows, model.reference_compat)
        metrics = spark.createDataFrame(scores.collect(), scores.schema)
    if path:
        save_model(fitted, spark, path, model, run)
    if log_path:
        trained_on = training_date or dt.date.today()
        append_training_log(spark, log_path, model_name, trained_on, metrics.first()["accuracy"], run)
    return fitted, metrics
