"""Registered queries and their SQL counterparts.

``queries()`` maps a name to a callable of (spark, folder of the test tables); ``oracle_sql()`` holds
the same result as SQL. What a model predicts has no SQL; the model queries compare everything else about
it, and the predictions of a target that can be learned exactly.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import sys
import uuid
import warnings
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.functions import vector_to_array  # noqa: E402
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T  # noqa: E402

from ebbline import schemas  # noqa: E402
from ebbline.functions import cells  # noqa: E402
from ebbline.operators import blocks, budget, features, flows, metrics, overrides, series, split  # noqa: E402
from ebbline.operators.scaling import RobustScale  # noqa: E402
from ebbline.options import ModelOptions, SeriesOptions, SplitOptions  # noqa: E402
from ebbline.plans import datasets, model, scoring, training  # noqa: E402
from ebbline.session import shared_folder, ship_package, stage  # noqa: E402
from ebbline.sources import buckets, readers, sinks, star  # noqa: E402
from oracle.sql import STATEMENTS  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, types that every client library returns alike."""
    as_type = {T.DecimalType: "DOUBLE", T.DateType: "STRING"}
    casts = {f.name: as_type.get(type(f.dataType)) for f in df.schema}
    return df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" if t else c for c, t in casts.items()])


def _rounded(df: DataFrame, names: list[str]) -> DataFrame:
    return df.selectExpr(*[f"round({c}, 6) AS {c}" if c in names else c for c in df.columns])


def _options(spark: SparkSession, sf_dir: str) -> SeriesOptions:
    """Options with hot customers, who are looked for among the orders."""
    customers = star.order_customers(spark, sf_dir)
    return SeriesOptions(cuts=blocks.find_cuts(star.transactions(spark, sf_dir), customers))


def _cut(flow_rows: DataFrame) -> SeriesOptions:
    """Options that cut customers between products, down to a row a block, as far as cuts go."""
    return SeriesOptions(cuts=blocks.find_cuts(flow_rows, hot_rows=1, block_rows=1))


def _request(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request: the customers of one market segment."""
    return star.profiles(spark, sf_dir).where("CategoryTypeCode = 'MACHINERY'").select("CustomerID")


def _new_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def transactions_scan(spark, sf_dir):
    return star.transactions(spark, sf_dir)


def transactions_for_customers(spark, sf_dir):
    return star.transactions(spark, sf_dir, request=_request(spark, sf_dir))


def trailing_three_months(spark, sf_dir):
    recent = readers.trailing_months(star.budget_transactions(spark, sf_dir))
    return recent.join(star.budgets(spark, sf_dir).select("BudgetID", "AllocatedAmount"), "BudgetID")


def budgets_active_in_window(spark, sf_dir):
    return readers.active_budgets(star.budgets(spark, sf_dir), star.budget_transactions(spark, sf_dir))


def category_dimension(spark, sf_dir):
    return star.categories(spark, sf_dir)


def daily_flows(spark, sf_dir):
    return flows.daily_flows(star.transactions(spark, sf_dir))


def monthly_flows(spark, sf_dir):
    return flows.monthly_flows(star.transactions(spark, sf_dir)).select(
        "CustomerID",
        "ProductCode",
        F.year("Date").alias("year"),
        F.month("Date").alias("Month"),
        "Credit",
        "Debit",
        (F.col("Credit") - F.col("Debit")).alias("NetFlow"),
    )


def unexpected_types_quarantine(spark, sf_dir):
    """The raw return flags as types, of which A and R are the known ones."""
    tx = star.transactions(spark, sf_dir, F.col("l_returnflag"))
    return flows.unexpected_types(tx, SeriesOptions(credit_type="A", debit_type="R"))


def _balances(spark, sf_dir):
    options = _options(spark, sf_dir)
    return series.running_balance(flows.monthly_flows(star.transactions(spark, sf_dir), options), options)


def _plain(df: DataFrame) -> DataFrame:
    return df.drop(blocks.BLOCK)


def monthly_balance(spark, sf_dir):
    return _plain(_balances(spark, sf_dir))


def positive_month_counts(spark, sf_dir):
    counts = series.positive_month_counts(_balances(spark, sf_dir))
    return counts.withColumn("Qualifies", F.col("PositiveMonths") == SeriesOptions().positive_months)


def eligible_series(spark, sf_dir):
    return _plain(series.eligible_series(_balances(spark, sf_dir)))


def prev_mean_balance(spark, sf_dir):
    return _plain(series.with_previous_mean(series.eligible_series(_balances(spark, sf_dir))))


def labelled_series(spark, sf_dir):
    return series.labelled_series(star.transactions(spark, sf_dir), _options(spark, sf_dir))


def labelled_series_in_blocks(spark, sf_dir):
    """The same result with the largest customers cut between products, as for hot ones."""
    daily = stage(flows.daily_flows(star.transactions(spark, sf_dir)), "daily")
    return series.labelled_series(daily, _cut(daily))


def latest_per_series(spark, sf_dir):
    return series.forecast_series(star.transactions(spark, sf_dir), _options(spark, sf_dir))


def _table(profiles: DataFrame, flow_rows: DataFrame) -> DataFrame:
    return _rounded(features.customer_features(profiles, flow_rows), schemas.FEATURE_COLUMNS[2:-1])


def _features(spark, sf_dir, request=None):
    return _table(star.profiles(spark, sf_dir, request), star.transactions(spark, sf_dir, request=request))


def _daily_and_table(spark, sf_dir, request=None):
    """Daily flows, stored for the series and the features alike, and the feature table."""
    daily = stage(flows.daily_flows(star.transactions(spark, sf_dir, request=request)), "daily")
    return daily, _table(star.profiles(spark, sf_dir, request), daily)


def customer_features(spark, sf_dir):
    return _features(spark, sf_dir)


def features_for_customers(spark, sf_dir):
    return _features(spark, sf_dir, _request(spark, sf_dir))


def feature_table_scan(spark, sf_dir):
    """A stored feature table of text columns, one name ending in a blank, read back as numbers."""
    path = _new_folder(spark, "features")
    named = {"Monthly_Count_Median_Debit": "Monthly_Count_Median_Debit "}
    as_text = [F.col(c).cast("string").alias(named.get(c, c)) for c in schemas.FEATURE_COLUMNS]
    _features(spark, sf_dir).select(as_text).write.parquet(path)
    return readers.scan_features(spark, readers.Source(path=path))


def sentinel_filled_features(spark, sf_dir):
    """Flow features before any default, -1 where a customer has none."""
    raw = features.flow_features(star.transactions(spark, sf_dir))
    names = raw.columns[1:]
    return raw.selectExpr("CustomerID", *[f"round({cells.filled(c)}, 6) AS {c}" for c in names])


def training_set(spark, sf_dir):
    daily, table = _daily_and_table(spark, sf_dir)
    return datasets.training_set(daily, table)


def training_set_in_blocks(spark, sf_dir):
    """The same with the largest customers cut between products."""
    daily, table = _daily_and_table(spark, sf_dir)
    return datasets.training_set(daily, table, _cut(daily))


def inference_set(spark, sf_dir):
    daily, table = _daily_and_table(spark, sf_dir)
    return datasets.inference_set(daily, table)


def inference_set_for_customers(spark, sf_dir):
    """The request applied to the tables as stored."""
    daily, table = _daily_and_table(spark, sf_dir, _request(spark, sf_dir))
    return datasets.inference_set(daily, table)


def _fitted_scale(spark, sf_dir):
    rows = stage(training_set(spark, sf_dir), "training")
    return rows, RobustScale.fit(rows, schemas.MODEL_FEATURES)


def scaler_stats(spark, sf_dir):
    _, scale = _fitted_scale(spark, sf_dir)
    return _rounded(scale.to_table(spark), ["median", "iqr"])


def scaler_roundtrip(spark, sf_dir):
    """The statistics as stored next to a model and read back."""
    _, scale = _fitted_scale(spark, sf_dir)
    path = _new_folder(spark, "model")
    model.save_scale(scale, spark, path)
    return _rounded(model.load_scale(spark, path).to_table(spark), ["median", "iqr"])


def _rounded_scale(scale: RobustScale) -> RobustScale:
    return RobustScale(tuple((f, round(median, 6), round(iqr, 6)) for f, median, iqr in scale.stats))


def scaled_features(spark, sf_dir):
    rows, scale = _fitted_scale(spark, sf_dir)
    scaled = _rounded_scale(scale).transform(rows)
    columns = [*schemas.IDENTIFIERS, *schemas.MODEL_FEATURES, schemas.TARGET]
    return _rounded(scaled.select(columns), schemas.MODEL_FEATURES)


def model_vectors(spark, sf_dir):
    """The vectors the trees see, taken apart again by position."""
    rows, scale = _fitted_scale(spark, sf_dir)
    prepared = model.prepare_stage(_rounded_scale(scale)).transform(rows)
    vectors = model.assembler().transform(prepared)
    cells = [f"round(v[{i}], 6) AS {name}" for i, name in enumerate(schemas.MODEL_FEATURES)]
    values = vectors.select(*schemas.IDENTIFIERS, schemas.TARGET, vector_to_array(model.VECTOR).alias("v"))
    return values.selectExpr(*schemas.IDENTIFIERS, *cells, schemas.TARGET)


def stratified_split_counts(spark, sf_dir):
    return split.split_counts(split.assign_split(labelled_series(spark, sf_dir)))


def stratified_split(spark, sf_dir):
    """Exact shares per label, row by row."""
    rows = stage(labelled_series(spark, sf_dir), "labelled")
    return split.assign_stratified_split(rows).select(*schemas.IDENTIFIERS, schemas.TARGET, "split")


def stratified_folds(spark, sf_dir):
    """The folds of the train part with exact shares per label, row by row."""
    folded = training.split_rows(stage(labelled_series(spark, sf_dir), "labelled"), SPLIT)
    return folded.where("split = 'train'").select(*schemas.IDENTIFIERS, schemas.TARGET, "fold")


def fold_counts(spark, sf_dir):
    return stratified_folds(spark, sf_dir).groupBy("fold", schemas.TARGET).agg(F.count(F.lit(1)).alias("rows"))


def hashed_fold_counts(spark, sf_dir):
    """Folds by the hash alone."""
    folded = split.assign_fold(labelled_series(spark, sf_dir))
    return folded.groupBy("fold", schemas.TARGET).agg(F.count(F.lit(1)).alias("rows"))


def _rule_scored(spark, sf_dir):
    """A scorer without a model: a customer struggling now is expected to struggle next month."""
    return split.assign_split(labelled_series(spark, sf_dir)).withColumn("prediction", F.col("Struggle"))


def confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(_rule_scored(spark, sf_dir), schemas.TARGET)


def rule_scorer_metrics(spark, sf_dir):
    return metrics.classification_metrics(
        _rule_scored(spark, sf_dir).where("split = 'test'"), schemas.TARGET
    )


def rule_scorer_auc(spark, sf_dir):
    scored = labelled_series(spark, sf_dir).withColumn("score", F.col("Prev_Mean_Bal") - F.col("Balance").cast("double"))
    area = metrics.roc_auc(scored, "score", schemas.TARGET)
    return spark.createDataFrame([(round(area, 9),)], "auc double")


def predictions_with_overrides(spark, sf_dir):
    """The rule scorer on each series' last row; customers of one segment have an override rule."""
    options = _options(spark, sf_dir)
    flagged = series.with_labels(series.balance_series(star.transactions(spark, sf_dir), options), options)
    last = series.next_month(series.latest_rows(flagged))
    rules = (
        star.profiles(spark, sf_dir)
        .where("CategoryTypeCode = 'BUILDING'")
        .select(
            "CustomerID",
            F.lit(1).alias("Struggle"),
            F.lit(3).alias("StruggleWeek"),
            F.lit(152).alias("FundingAmount"),
        )
    )
    return overrides.with_overrides(last, rules)


def prediction_records(spark, sf_dir):
    return sinks.response_fields(predictions_with_overrides(spark, sf_dir))


def predictions_sink_roundtrip(spark, sf_dir):
    path = _new_folder(spark, "predictions")
    sinks.append_predictions(predictions_with_overrides(spark, sf_dir), path)
    return sinks.read_predictions(spark, path)


def weekly_budget(spark, sf_dir):
    return budget.weekly_budget(star.transactions(spark, sf_dir), star.profiles(spark, sf_dir))


def weekly_budget_reload(spark, sf_dir):
    """Written, then replaced by a second write, then read back."""
    path, rows = _new_folder(spark, "weekly-budget"), weekly_budget(spark, sf_dir)
    sinks.reload_weekly_budget(rows, path)
    sinks.reload_weekly_budget(rows, path)
    return readers.scan_weekly_budget(spark, readers.Source("committed", path))


def training_log_roundtrip(spark, sf_dir):
    """The rule scorer's accuracy as a row of the training log."""
    path, score = _new_folder(spark, "training-log"), rule_scorer_metrics(spark, sf_dir).first()["accuracy"]
    sinks.append_training_log(spark, path, "rule", dt.date(2023, 1, 21), score)
    return sinks.read_training_log(spark, path)


def _stored(spark, df, label) -> readers.Source:
    """``df`` as a table of its own, to be scanned like any other."""
    path = _new_folder(spark, label)
    df.write.parquet(path)
    return readers.Source(path=path)


def stored_transactions_for_customers(spark, sf_dir):
    """A stored transaction table, scanned for requested customers."""
    source = _stored(spark, star.transactions(spark, sf_dir), "transactions")
    return readers.scan_transactions(spark, source, _request(spark, sf_dir))


def _bucketed(spark, sf_dir) -> str:
    """Daily flows stored by customer."""
    path = _new_folder(spark, "flows")
    buckets.store_flows(star.transactions(spark, sf_dir), path, buckets=16)
    return path


def bucketed_labelled_series(spark, sf_dir):
    """Series from flows that are stored by customer: no shuffle."""
    return series.labelled_series(*buckets.open_series(spark, _bucketed(spark, sf_dir)))


def bucketed_flows_for_customers(spark, sf_dir):
    """Flows of requested customers, from their buckets."""
    return buckets.open_series(spark, _bucketed(spark, sf_dir), _request(spark, sf_dir))[0]


def stored_features_for_customers(spark, sf_dir):
    """A stored feature table, scanned for requested customers."""
    source = _stored(spark, _features(spark, sf_dir), "features")
    return readers.scan_features(spark, source, _request(spark, sf_dir))


def _stored_budgets(spark, sf_dir):
    """Scans of stored budgets and of their transactions, which carry the budget's amount."""
    budgets = star.budgets(spark, sf_dir)
    spent = star.budget_transactions(spark, sf_dir).join(budgets.select("BudgetID", "AllocatedAmount"), "BudgetID")
    return (
        readers.scan_budgets(spark, _stored(spark, budgets, "budgets")),
        readers.scan_budget_transactions(spark, _stored(spark, spent, "budget-transactions")),
    )


def stored_trailing_months(spark, sf_dir):
    return readers.trailing_months(_stored_budgets(spark, sf_dir)[1])


def stored_flows_of_trailing_months(spark, sf_dir):
    """The last three months of stored daily flows, whose last day is read from the files' footers."""
    source = _stored(spark, flows.daily_flows(star.transactions(spark, sf_dir)), "daily-flows")
    with readers.from_statistics(spark):
        return readers.trailing_months(source.load(spark), date="Day")


def stored_budgets_in_window(spark, sf_dir):
    return readers.active_budgets(*_stored_budgets(spark, sf_dir))


def stored_categories(spark, sf_dir):
    return readers.scan_categories(spark, _stored(spark, star.categories(spark, sf_dir), "categories"))


def detected_types_monthly_flows(spark, sf_dir):
    """Credit and debit types taken from the data by position."""
    tx = star.transactions(spark, sf_dir)
    credit, debit = flows.detect_types(tx)
    monthly = flows.monthly_flows(tx, SeriesOptions(credit_type=credit, debit_type=debit))
    return monthly.select(
        "CustomerID",
        "ProductCode",
        F.year("Date").alias("year"),
        F.month("Date").alias("Month"),
        "Credit",
        "Debit",
        (F.col("Credit") - F.col("Debit")).alias("NetFlow"),
    )


# The engine's defaults; only how many areas of the grid are computed side by side is set here.
MODEL = ModelOptions(parallelism=10)
SPLIT = SplitOptions()
# Models trained in this process by session, folder of the tables and target, so that queries share them.
_trained_models: dict[tuple, Trained] = {}


@dataclass(frozen=True)
class Trained:
    """Inputs of the scoring flows, the folder of the stored model, the model itself and its metrics."""

    daily: DataFrame
    table: DataFrame
    path: str
    fitted: model.FittedModel
    metrics: DataFrame | None


def _once(spark, sf_dir, kind: str, train: Callable[[], Trained]) -> Trained:
    # A table that was written anew in the same folder gets a model of its own.
    files = spark.read.format("binaryFile").load(f"{sf_dir}/lineitem.parquet")
    written = sorted(map(tuple, files.select("path", "modificationTime", "length").collect()))
    key = spark.sparkContext.applicationId, kind, tuple(written)
    if key not in _trained_models:
        _trained_models[key] = train()
    return _trained_models[key]


def _trained(spark, sf_dir) -> Trained:
    """The training flow on the real target."""

    def train():
        daily, table = _daily_and_table(spark, sf_dir)
        table, path = stage(table, "features"), _new_folder(spark, "model")
        fitted, scores = training.train(daily, table, split=SPLIT, model=MODEL, path=path)
        return Trained(daily, table, path, fitted, scores)

    return _once(spark, sf_dir, "struggle", train)


def _trained_on_segments(spark, sf_dir) -> Trained:
    """The same steps on a target that is a function of one input: SegmentID above 3."""

    def train():
        daily, table = _daily_and_table(spark, sf_dir)
        rows = datasets.training_set(daily, table)
        rows = rows.withColumn(schemas.TARGET, (F.col("SegmentID") > 3).cast("int"))
        rows = stage(rows, "segments")
        path = _new_folder(spark, "model")
        fitted = training.train_on(training.split_rows(rows, SPLIT), MODEL, SPLIT)
        model.save_model(fitted, spark, path, MODEL)
        return Trained(rows, table, path, fitted, None)

    return _once(spark, sf_dir, "segments", train)


def segment_predictions(spark, sf_dir):
    """Train, store, load and predict a target that can be learned exactly: shows the wiring and the
    values, not the quality of the trees."""
    trained = _trained_on_segments(spark, sf_dir)
    found = scoring.predict(trained.daily, model.load_model(spark, trained.path).pipeline)
    return found.withColumnRenamed("Struggle", "predicted")


def segment_predictions_by_drawn_columns(spark, sf_dir):
    """The same with columns drawn per tree and second-order leaves; one depth and 20 trees learn this target."""

    def train():
        rows = _trained_on_segments(spark, sf_dir).daily
        options = dataclasses.replace(MODEL, columns_per_tree=True, max_depths=(4,), max_iter=min(20, MODEL.max_iter))
        fitted, path = training.train_on(training.split_rows(rows, SPLIT), options, SPLIT), _new_folder(spark, "model")
        model.save_model(fitted, spark, path, options)
        return Trained(rows, rows, path, fitted, None)

    trained = _once(spark, sf_dir, "segments by drawn columns", train)
    found = scoring.predict(trained.daily, model.load_model(spark, trained.path).pipeline)
    return found.withColumnRenamed("Struggle", "predicted")


def segment_grid_auc(spark, sf_dir):
    """Mean AUC over five folds for each depth of the grid, on the target that can be learned exactly."""
    fitted = _trained_on_segments(spark, sf_dir).fitted
    return spark.createDataFrame(list(fitted.auc_by_depth), "max_depth int, mean_auc double")


def _with_check(df: DataFrame, *names: str) -> DataFrame:
    """Struggle replaced by whether it is a label at all: its values are the trees' own."""
    return df.select(*names, F.col("Struggle").isin(0, 1).alias("is_label"))


def stored_model_agrees(spark, sf_dir):
    """Row by row: does the stored and loaded model predict what the one in memory does?"""
    trained = _trained(spark, sf_dir)
    rows = stage(datasets.inference_set(trained.daily, trained.table), "inference")
    loaded = scoring.predict(rows, model.load_model(spark, trained.path).pipeline).withColumnRenamed("Struggle", "loaded")
    both = scoring.predict(rows, trained.fitted.pipeline).join(loaded, schemas.IDENTIFIERS)
    return both.select(*schemas.IDENTIFIERS, (F.col("Struggle") == F.col("loaded")).alias("agrees"))


def _scored(spark, sf_dir, request=None):
    trained = _trained(spark, sf_dir)
    pipeline = model.load_model(spark, trained.path).pipeline
    return scoring.score(trained.daily, trained.table, pipeline, request)


def model_predictions(spark, sf_dir):
    """Train, store, load, then score everyone."""
    return _with_check(_scored(spark, sf_dir), *schemas.IDENTIFIERS, "StruggleWeek", "FundingAmount")


def scored_sink(spark, sf_dir):
    """The batch flow: score everyone into the predictions table, then read that back."""
    trained, path = _trained(spark, sf_dir), _new_folder(spark, "scored")
    pipeline = model.load_model(spark, trained.path).pipeline
    scoring.score_all(trained.daily, trained.table, pipeline, path)
    return _with_check(sinks.read_predictions(spark, path), "CustomerID", "Date")


def score_customers(spark, sf_dir):
    """JSON records for requested customers, with the predicted label, 0 or 1, written as #."""
    trained = _trained(spark, sf_dir)
    pipeline = model.load_model(spark, trained.path).pipeline
    records = scoring.score_customers(trained.daily, trained.table, pipeline, _request(spark, sf_dir))
    return records.select(F.regexp_replace("record", '"Struggle":[01],', '"Struggle":#,').alias("record"))


def model_metrics(spark, sf_dir):
    """The test rows of either label, added up from the confusion of the trained model."""
    scores = _trained(spark, sf_dir).metrics
    return scores.select(
        (F.col("tp") + F.col("fn")).alias("struggling"),
        (F.col("fp") + F.col("tn")).alias("calm"),
        F.col("accuracy").between(0, 100).alias("accuracy_is_percent"),
    )


def grid_search_auc(spark, sf_dir):
    """Whether the mean AUC over five folds is better than chance, for each depth of the grid."""
    rows = [(depth, 0.5 < auc <= 1) for depth, auc in _trained(spark, sf_dir).fitted.auc_by_depth]
    return spark.createDataFrame(rows, "max_depth int, better_than_chance boolean")


REGISTERED: list[Query] = [
    transactions_scan,
    transactions_for_customers,
    trailing_three_months,
    budgets_active_in_window,
    category_dimension,
    daily_flows,
    monthly_flows,
    unexpected_types_quarantine,
    monthly_balance,
    positive_month_counts,
    eligible_series,
    prev_mean_balance,
    labelled_series,
    labelled_series_in_blocks,
    latest_per_series,
    customer_features,
    features_for_customers,
    feature_table_scan,
    sentinel_filled_features,
    training_set,
    training_set_in_blocks,
    inference_set,
    inference_set_for_customers,
    scaler_stats,
    scaler_roundtrip,
    scaled_features,
    model_vectors,
    stratified_split_counts,
    stratified_split,
    stratified_folds,
    fold_counts,
    hashed_fold_counts,
    confusion_counts,
    rule_scorer_metrics,
    rule_scorer_auc,
    predictions_with_overrides,
    prediction_records,
    predictions_sink_roundtrip,
    weekly_budget,
    weekly_budget_reload,
    stored_transactions_for_customers,
    bucketed_labelled_series,
    bucketed_flows_for_customers,
    stored_features_for_customers,
    stored_trailing_months,
    stored_flows_of_trailing_months,
    stored_budgets_in_window,
    stored_categories,
    detected_types_monthly_flows,
    training_log_roundtrip,
    segment_predictions,
    segment_predictions_by_drawn_columns,
    segment_grid_auc,
    stored_model_agrees,
    model_predictions,
    scored_sink,
    model_metrics,
    grid_search_auc,
    score_customers,
]


def _corpus() -> tuple[list[Query], dict[str, str]]:
    """Queries and SQL of the text operators; none where they, or a package that they need, cannot be imported."""
    try:
        import corpus_pipeline
        from ebbline.llm import queries as corpus, sql as corpus_sql
    except ImportError as missing:
        warnings.warn(f"queries on texts are not registered: {missing}", stacklevel=2)
        return [], {}
    statements = dict(corpus_sql.STATEMENTS)
    if corpus_pipeline.ORACLE_SQL:
        statements["pipeline"] = corpus_pipeline.ORACLE_SQL

    def pipeline(spark, sf_dir):
        return corpus_pipeline.run(spark, sf_dir)

    return [*corpus.QUERIES, pipeline], statements


def entry(spark: SparkSession) -> DataFrame:
    """Labelled series on the smallest tables."""
    return labelled_series(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    def registered(query: Query) -> Query:
        return lambda spark, sf_dir: comparable(query(spark, sf_dir))

    def shipped(query: Query) -> Query:
        """For sessions whose Python workers do not know this repository."""
        return lambda spark, sf_dir: (ship_package(spark), query(spark, sf_dir))[1]

    own = {query.__name__: registered(query) for query in REGISTERED}
    return own | {query.__name__: shipped(query) for query in _corpus()[0]}


def oracle_sql() -> dict[str, str]:
    return STATEMENTS | _corpus()[1]
