"""Shape of the physical plans."""

import re

import pytest

import __spark_entry__ as registry
from ebbline.operators import features, series
from ebbline.plans import datasets
from ebbline.sources import readers, requests, star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(text):
    return re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)


PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "PythonUDF")
LAZY = [
    "monthly_balance",
    "eligible_series",
    "labelled_series",
    "latest_per_series",
    "customer_features",
    "training_set",
    "inference_set",
    "predictions_with_overrides",
    "weekly_budget",
]


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_and_no_single_partition_window(spark, sf_dir, name):
    text = plan(registry.queries()[name](spark, sf_dir))
    assert not any(node in text for node in PYTHON)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Exchange SinglePartition" not in text


def test_series_takes_two_shuffles_and_one_sort(spark, sf_dir):
    text = plan(series.labelled_series(star.transactions(spark, sf_dir)))
    exchanges = hash_exchanges(text)
    assert len(exchanges) == 2
    assert re.fullmatch(r"CustomerID#\d+", exchanges[0])
    assert len(re.findall(r"\bSort \[", text)) == 1
    assert "partial_sum" in text


def test_series_reads_only_its_columns(spark, sf_dir):
    text = plan(series.labelled_series(star.transactions(spark, sf_dir)))
    schemas_read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    columns = sorted(re.findall(r"(\w+):", ",".join(schemas_read)))
    assert columns == [
        "l_extendedprice", "l_linestatus", "l_orderkey", "l_returnflag", "o_custkey", "o_orderdate", "o_orderkey",
    ]


def test_features_join_the_series_without_another_shuffle_of_it(spark, sf_dir):
    """Both sides arrive grouped by customer: the series from its windows, the features from theirs."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tx = star.transactions(spark, sf_dir)
        table = features.customer_features(star.profiles(spark, sf_dir), tx)
        text = plan(datasets.training_set(tx, table))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_customer = [e for e in hash_exchanges(text) if re.fullmatch(r"CustomerID#\d+", e)]
    # One for the series, one for the customer profile, one for the flow features.
    assert len(by_customer) == 3


def test_trailing_window_pushes_both_bounds(spark, sf_dir):
    """Both bounds of the date are filters of the scan that reads the rows."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = plan(readers.trailing_months(star.budget_transactions(spark, sf_dir)))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    [pushed] = re.findall(r"PushedFilters: \[([^\n]*?)\], ReadSchema: struct<([^>]*)>", text)
    assert "GreaterThanOrEqual(o_orderdate" in pushed[0] and "LessThanOrEqual(o_orderdate" in pushed[0]
    assert "o_totalprice" in pushed[1] and "Join" not in text


def test_bounds_come_from_footers(spark, tmp_path, monkeypatch):
    """The window's bounds push the maximum into the scan, and the rows are filtered by it."""
    path, plans = str(tmp_path / "days"), []
    days = "explode(sequence(date'2023-01-01', date'2023-12-31', interval 1 day)) AS Day"
    spark.range(3).selectExpr("id", days).write.parquet(path)

    def noted(self, *args):
        plans.append(plan(agg(self, *args)))
        return agg(self, *args)

    before = {key: spark.conf.get(key) for key in readers.FROM_STATISTICS}
    with readers.from_statistics(spark):
        loaded = readers.Source(path=path).load(spark)
        agg = type(loaded).agg
        monkeypatch.setattr(type(loaded), "agg", noted)
        recent = readers.trailing_months(loaded, date="Day")
    monkeypatch.undo()
    assert "PushedAggregation: [MAX(Day)" in plans[0] and "ReadSchema: struct<max(Day):date>" in plans[0]
    assert "GreaterThanOrEqual(Day,2023-09-30)" in plan(recent)
    assert recent.count() == 3 * 93
    assert {key: spark.conf.get(key) for key in before} == before


@pytest.mark.parametrize("key, pushed", [("string", "In(CustomerID, [1,2])"), ("bigint", "In(CustomerID, [1,2])")])
def test_requested_ids_reach_the_parquet_scan(spark, tmp_path, key, pushed):
    path = str(tmp_path / "tx")
    names = "ProductCode string, TransAmount double, TransDate string, TransType string"
    spark.createDataFrame([], f"CustomerID {key}, {names}").write.parquet(path)
    tx = readers.scan_transactions(spark, readers.Source(path=path), ["1", "2"])
    assert pushed in plan(series.labelled_series(tx))


def test_predictions_are_rebalanced_by_date(spark, sf_dir):
    from ebbline.sources import sinks

    text = plan(sinks.by_date(registry.predictions_with_overrides(spark, sf_dir)))
    assert re.search(r"Exchange hashpartitioning\(Date#\d+, \d+\), REBALANCE_PARTITIONS_BY_COL", text)


def test_hot_customers_move_the_monthly_rows_once(spark, sf_dir):
    """All rows are grouped once, by customer and block, and sorted once; what hot customers' blocks tell each
    other is broadcast."""
    text = plan(registry.labelled_series_in_blocks(spark, sf_dir))
    exchanges = [e for e in hash_exchanges(text) if re.fullmatch(r"CustomerID#\d+, ProductBlock#\d+", e)]
    # The rows, the hot customers' answers and their openings, twice as these go into both.
    assert len(exchanges) == 4
    # Only hot customers' rows are read again.
    assert len(re.findall(r"DataFilters: \[[^\n]*NOT \(ProductBlock#\d+ = -1\)", text)) == 3
    assert "SortMergeJoin" not in text


def test_features_of_hot_customers_are_copied_to_their_blocks(spark, sf_dir):
    text = plan(registry.training_set_in_blocks(spark, sf_dir))
    assert "Generate explode" in text and "distinct" not in text.lower()


def test_a_request_restricts_orders_before_the_join(spark, sf_dir, monkeypatch):
    """The join with the line items takes only the requested customers' orders."""
    request = star.profiles(spark, sf_dir).where("SegmentID = 1").select("CustomerID")
    short = plan(star.transactions(spark, sf_dir, request=request))
    assert re.search(r"PushedFilters: \[[^\n]*In\(o_custkey", short)
    monkeypatch.setattr(requests, "INLINE_IDS", 3)
    tx = star.transactions(spark, sf_dir, request=request)
    optimized = tx._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.index("Join Inner") < optimized.index("Join LeftSemi")
    assert "LeftSemi, BuildRight" in plan(tx)
