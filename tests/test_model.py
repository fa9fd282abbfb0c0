"""Training, storage and scoring with a small model."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.operators import features, overrides
from ebbline.operators.scaling import RobustScale
from ebbline.options import ModelOptions, SeriesOptions
from ebbline.plans import datasets, model, scoring, training
from ebbline.session import stage
from ebbline.sources import commits, sinks, star

SMALL = ModelOptions(max_iter=2, max_depths=(4,))
# The smallest tables have few eligible customers; a lower bar gives the trees something to learn.
SERIES = SeriesOptions(positive_months=6)


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    tx = stage(star.transactions(spark, sf_dir), "tx")
    table = stage(features.customer_features(star.profiles(spark, sf_dir), tx), "features")
    return tx, table


@pytest.fixture(scope="module")
def trained(spark, inputs, tmp_path_factory):
    folder = tmp_path_factory.mktemp("model")
    fitted, scores = training.train(
        *inputs, series=SERIES, model=SMALL, path=str(folder / "m"), log_path=str(folder / "log"),
        training_date=dt.date(2023, 1, 21),
    )
    return fitted, scores, folder


def test_training_evaluates_and_logs(spark, inputs, trained):
    _, scores, folder = trained
    row = scores.first()
    rows = datasets.training_set(*inputs, SERIES).count()
    assert row["tp"] + row["fp"] + row["fn"] + row["tn"] == -(-rows // 5)
    logged = spark.read.parquet(str(folder / "log")).collect()
    assert [(r["ModelName"], r["TrainingDate"], r["ModelScore"]) for r in logged] == [
        ("struggle", dt.date(2023, 1, 21), row["accuracy"])
    ]


def test_stored_model_predicts_the_same(spark, inputs, trained):
    fitted, _, folder = trained
    stored = model.load_model(spark, str(folder / "m"))
    loaded = stored.pipeline
    rows = datasets.inference_set(*inputs, options=SERIES)
    columns = [*schemas.IDENTIFIERS, "probability", "prediction"]
    first = fitted.pipeline.transform(rows).select(columns)
    second = loaded.transform(rows).select(columns)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))
    assert stored.scale == fitted.scale and stored.depth == fitted.depth
    assert stored.options["max_iter"] == SMALL.max_iter


def test_an_interrupted_save_leaves_the_last_model(spark, trained, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    first = model.save_model(trained[0], spark, path, SMALL)

    def fails(*args):
        raise OSError("disk full")

    monkeypatch.setattr(model, "save_scale", fails)
    with pytest.raises(OSError):
        model.save_model(trained[0], spark, path, SMALL)
    assert model.load_model(spark, path).digest == first
    assert commits.versions(spark, path) == [1]


def test_a_mixed_bundle_is_refused(spark, trained, tmp_path):
    path = str(tmp_path / "m")
    model.save_model(trained[0], spark, path)
    [folder] = commits.folders(spark, path)
    other = RobustScale(tuple((name, median + 1, iqr) for name, median, iqr in trained[0].scale.stats))
    other.to_table(spark).coalesce(1).write.mode("overwrite").parquet(f"{folder}/scaler")
    with pytest.raises(ValueError, match="not those of its commit"):
        model.load_model(spark, path)


def test_models_have_versions(spark, trained, tmp_path):
    path = str(tmp_path / "m")
    for run in ("a", "a", "b"):
        model.save_model(trained[0], spark, path, SMALL, run)
    assert commits.versions(spark, path) == [1, 2]
    assert model.load_model(spark, path, 1).scale == model.load_model(spark, path).scale
    with pytest.raises(FileNotFoundError):
        model.load_model(spark, str(tmp_path / "none"))


def test_scores_have_one_row_per_series(spark, inputs, trained):
    fitted = trained[0]
    found = scoring.score(*inputs, fitted.pipeline, series=SERIES)
    assert found.columns == ["CustomerID", "ProductCode", "Date", "Struggle", "StruggleWeek", "FundingAmount"]
    assert found.count() == datasets.inference_set(*inputs, options=SERIES).count()
    assert {r[0] for r in found.select("Struggle").distinct().collect()} <= {0, 1}


def test_requested_scores_equal_the_full_ones(spark, inputs, trained):
    pipeline = trained[0].pipeline
    every = scoring.score(*inputs, pipeline, series=SERIES)
    ids = [r[0] for r in every.select("CustomerID").distinct().orderBy("CustomerID").limit(4).collect()]
    rules = spark.createDataFrame([(ids[0], 1, 3, 152)], schemas.OVERRIDE_RULES)
    asked = scoring.score_customers(*inputs, pipeline, [*ids, "no such customer"], series=SERIES, rules=rules)
    records = [json.loads(r["record"]) for r in asked.collect()]
    wanted = every.where(F.col("CustomerID").isin(ids)).count()
    assert len(records) == wanted and {r["CustomerID"] for r in records} == set(ids)
    assert all((r["StruggleWeek"], r["FundingAmount"]) == ((3, 152) if r["CustomerID"] == ids[0] else (0, 0)) for r in records)


def test_score_all_appends_a_run_once(spark, inputs, trained, tmp_path):
    path = str(tmp_path / "predictions")
    for _ in range(2):
        scoring.score_all(*inputs, trained[0].pipeline, path, run="2023-01", series=SERIES)
    expected = scoring.score(*inputs, trained[0].pipeline, series=SERIES).count()
    assert sinks.read_predictions(spark, path).count() == expected


def test_customers_without_features_drop_out(inputs, trained):
    tx, table = inputs
    fewer = table.where("SegmentID <> 1")
    kept = datasets.inference_set(tx, fewer, options=SERIES)
    assert kept.where("SegmentID = 1").isEmpty() and 0 < kept.count() < datasets.inference_set(tx, table, options=SERIES).count()


def test_duplicate_features_multiply_training_rows(inputs):
    tx, table = inputs
    assert datasets.training_set(tx, table.union(table), SERIES).count() == 2 * datasets.training_set(tx, table, SERIES).count()


def test_duplicate_features_are_not_scored_twice(inputs):
    tx, table = inputs
    older = table.withColumn("Age", F.col("Age") - 1)
    with pytest.raises(Exception, match="duplicate CustomerID"):
        datasets.inference_set(tx, table.union(older), options=SERIES).collect()
    newest = datasets.inference_set(tx, table.union(older), options=SERIES, newest_by=["Age"])
    assert newest.exceptAll(datasets.inference_set(tx, table, options=SERIES)).isEmpty() and not newest.isEmpty()


def test_missing_features_are_scored(inputs, trained):
    tx, table = inputs
    holed = table.withColumn("Age", F.lit(None).cast("double")).withColumn("Week_1_Avg_Credit", F.lit(float("nan")))
    found = scoring.score(tx, holed, trained[0].pipeline, series=SERIES)
    assert found.where("Struggle IS NULL").isEmpty() and not found.isEmpty()


def test_compatible_training_uses_raw_values(spark, inputs):
    fitted, scores = training.train(*inputs, series=SERIES, model=ModelOptions(max_iter=2, max_depths=(4,), reference_compat=True))
    every = datasets.training_set(*inputs, SERIES)
    from ebbline.operators.scaling import RobustScale

    assert fitted.scale == RobustScale.fit(stage(every, "rows"), schemas.MODEL_FEATURES)
    assert scores.first()["accuracy"] > 50


def test_grid_search_reports_every_depth(inputs):
    fitted, _ = training.train(*inputs, series=SERIES, model=ModelOptions(max_iter=1, max_depths=(2, 3)))
    assert [d for d, _ in fitted.auc_by_depth] == [2, 3]
    best = max(fitted.auc_by_depth, key=lambda pair: pair[1])
    assert fitted.depth == best[0] and 0 < best[1] <= 1


def test_rules_must_be_unique(spark, inputs, trained):
    rules = spark.createDataFrame([("1", 1, 1, 1), ("1", 0, 0, 0)], schemas.OVERRIDE_RULES)
    with pytest.raises(Exception, match="duplicate CustomerID"):
        overrides.with_overrides(scoring.score(*inputs, trained[0].pipeline, series=SERIES), rules).collect()
