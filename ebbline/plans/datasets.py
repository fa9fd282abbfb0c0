"""Model inputs: series joined with customer features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ebbline import schemas
from ebbline.operators.blocks import with_cuts
from ebbline.operators.features import attach_features, latest_per_key, require_unique
from ebbline.operators.series import forecast_series, labelled_series
from ebbline.options import SeriesOptions
from ebbline.sources.requests import Request, for_customers, resolve

DEFAULTS = SeriesOptions()
AMOUNTS = ["Credit", "Debit", "Balance"]


def _numeric(df: DataFrame, *extra: str) -> DataFrame:
    names = [*schemas.IDENTIFIERS, *AMOUNTS, "Prev_Mean_Bal", *extra, *schemas.FEATURE_COLUMNS[1:]]
    return df.selectExpr(*[f"CAST({c} AS DOUBLE) AS {c}" if c in AMOUNTS else c for c in names])


def training_set(flows: DataFrame, features: DataFrame, options: SeriesOptions = DEFAULTS) -> DataFrame:
    """Every eligible row with Struggle, its label and the customer's features, from transactions or
    daily flows."""
    options = with_cuts(flows, options)
    joined = attach_features(labelled_series(flows, options, keep_blocks=True), features, options.cuts)
    return _numeric(joined, "Struggle", schemas.TARGET)


def inference_set(
    flows: DataFrame,
    features: DataFrame,
    request: Request = None,
    options: SeriesOptions = DEFAULTS,
    newest_by: Sequence[str] = (),
) -> DataFrame:
    """The row to score of each eligible series, for all customers or the requested ones.

    The request restricts both inputs before anything is computed; given to the scans already, it
    need not be repeated here. The last rows are picked before
    the join, which then moves one row per series. A series is scored once: a customer with several
    feature rows is an error unless ``newest_by`` names the columns that pick one.
    """
    request = resolve(request)
    flows = for_customers(flows, request)
    options = with_cuts(flows, options)
    latest = forecast_series(flows, options, keep_blocks=True)
    asked = for_customers(features, request)
    single = latest_per_key(asked, *newest_by) if newest_by else require_unique(asked)
    return _numeric(attach_features(latest, single, options.cuts))
