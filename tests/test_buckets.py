"""Daily flows stored by customer."""

import re

import pytest
from pyspark.sql import functions as F

from ebbline.operators import blocks, flows, series
from ebbline.options import SeriesOptions
from ebbline.sources import buckets, requests, star

OPTIONS = SeriesOptions(positive_months=6)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tx(spark, sf_dir):
    return star.transactions(spark, sf_dir)


@pytest.fixture(scope="module")
def stored(spark, tx, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("flows"))
    buckets.store_flows(tx, path, 8)
    return path


def test_series_from_buckets_need_no_shuffle(spark, tx, stored):
    found = series.labelled_series(*buckets.open_series(spark, stored, options=OPTIONS))
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(series.labelled_series(tx, OPTIONS))


def test_a_request_reads_its_buckets(spark, tx, stored):
    ids = [r[0] for r in tx.select("CustomerID").distinct().orderBy("CustomerID").limit(2).collect()]
    found, options = buckets.open_series(spark, stored, ids, OPTIONS)
    expected = flows.daily_flows(tx.where(F.col("CustomerID").isin(ids))).select(found.columns)
    assert rows(found) == rows(expected)
    scored = series.forecast_series(found, options)
    [(read, every)] = re.findall(r"SelectedBucketsCount: (\d+) out of (\d+)", plan(scored))
    assert int(read) <= 2 and every == "8"
    assert "Exchange" not in plan(scored)
    assert scored.columns == series.forecast_series(tx, OPTIONS).columns


def ids_in(tx, bucket_numbers, buckets_in_all):
    number = F.pmod(F.hash("CustomerID"), F.lit(buckets_in_all))
    return tx.select("CustomerID").distinct().where(number.isin(list(bucket_numbers)))


@pytest.mark.parametrize("as_frame", [True, False])
def test_a_long_request_reads_the_files_of_its_buckets(spark, tx, stored, monkeypatch, as_frame):
    monkeypatch.setattr(requests, "INLINE_IDS", 2)
    monkeypatch.setattr(buckets, "INLINE_IDS", 2)
    asked = ids_in(tx, (1, 4, 6), 8)
    ids = [r[0] for r in asked.collect()]
    found, options = buckets.open_series(spark, stored, asked if as_frame else ids, OPTIONS)
    assert len([name for name in found.inputFiles() if stored in name]) == 3
    assert rows(found) == rows(flows.daily_flows(tx.where(F.col("CustomerID").isin(ids))).select(found.columns))
    whole = series.labelled_series(tx, OPTIONS).where(F.col("CustomerID").isin(ids))
    assert rows(series.labelled_series(found, options)) == rows(whole)


def test_a_request_for_all_buckets_moves_only_the_request(spark, tx, stored, monkeypatch):
    monkeypatch.setattr(requests, "INLINE_IDS", 2)
    monkeypatch.setattr(buckets, "INLINE_IDS", 2)
    found, options = buckets.open_series(spark, stored, tx.select("CustomerID"), OPTIONS)
    assert "Exchange hashpartitioning(CustomerID" not in plan(series.labelled_series(found, options))
    assert found.count() == flows.daily_flows(tx).count()
    none, _ = buckets.open_series(spark, stored, ["no", "such", "customers"], OPTIONS)
    assert none.count() == 0


def test_storing_anew_replaces_and_keeps_its_rows_sorted(spark, tx, tmp_path):
    path = str(tmp_path / "flows")
    buckets.store_flows(tx, path, 4)
    before = buckets.open_flows(spark, path)
    few = tx.where("CustomerID < '2'")
    buckets.store_flows(few, path, 3, run="again")
    buckets.store_flows(tx, path, 3, run="again")
    assert rows(buckets.open_flows(spark, path)) == rows(flows.daily_flows(few).select(before.columns))
    assert before.count() == flows.daily_flows(tx).count()
    assert rows(buckets.open_flows(spark, path, by_bucket=False)) == rows(buckets.open_flows(spark, path))


def test_hot_customers_are_remembered_and_spread(spark, tx, tmp_path, monkeypatch):
    path = str(tmp_path / "flows")
    monkeypatch.setattr(blocks.find_cuts, "__defaults__", (None, 1, 1, blocks.MAX_CUTS))
    buckets.store_flows(tx, path, 4)
    monkeypatch.undo()
    found, options = buckets.open_series(spark, path, options=OPTIONS)
    assert options.cuts and "SelectedBucketsCount" not in plan(series.labelled_series(found, SeriesOptions(cuts=())))
    assert rows(series.labelled_series(found, options)) == rows(series.labelled_series(tx, OPTIONS))


def test_nothing_stored(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        buckets.open_series(spark, str(tmp_path / "none"))
