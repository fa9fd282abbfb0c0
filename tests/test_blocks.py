import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.operators import blocks, features, flows, series
from ebbline.options import SeriesOptions


def pairs(spark, rows):
    return spark.createDataFrame(rows, "CustomerID string, ProductCode string")


def test_ordinary_customers_are_not_cut(spark):
    assert blocks.find_cuts(pairs(spark, [(f"c{i % 50}", f"P{i % 7}") for i in range(500)])) == ()
    assert blocks.find_cuts(pairs(spark, [])) == ()
    assert blocks.find_cuts(pairs(spark, [(None, "P"), ("c", None)] * 50), hot_rows=1) == ()


def test_only_hot_customers_are_cut_into_even_ranges(spark):
    rows = [("hot", f"{i * 7919 % 1000:04d}") for i in range(3000)] + [(f"c{i}", f"P{i % 3}") for i in range(3000)]
    [(name, codes)] = blocks.find_cuts(pairs(spark, rows), hot_rows=1000, block_rows=300)
    assert name == "hot" and list(codes) == sorted(codes) and len(codes) == 9
    per_block = [0] * 10
    for customer, code in rows[:3000]:
        per_block[blocks.block_of(customer, code, ((name, codes),))] += 1
    assert max(per_block) <= 303


def test_one_code_with_most_rows_is_a_block_of_its_own(spark):
    rows = [("hot", "M")] * 900 + [("hot", code) for code in "ABXYZ"]
    assert blocks.find_cuts(pairs(spark, rows), hot_rows=100, block_rows=100) == (("hot", ("X",)),)


def test_cuts_are_bounded(spark):
    rows = [(f"c{i % 40}", f"{i:05d}") for i in range(4000)]
    cuts = blocks.find_cuts(pairs(spark, rows), hot_rows=1, block_rows=1, max_cuts=64)
    assert 0 < sum(len(codes) for _, codes in cuts) <= 64


def test_a_cheaper_table_may_name_the_customers(spark):
    flow_rows = pairs(spark, [("hot", f"{i:04d}") for i in range(400)] + [("c", "A")] * 400)
    named = spark.createDataFrame([("hot",)] * 50 + [("c",)], "CustomerID string")
    assert [name for name, _ in blocks.find_cuts(flow_rows, named, hot_rows=40, block_rows=10)] == ["hot"]


def test_samples_find_hot_customers(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SAMPLE_ROWS", 2000)
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("CustomerID"),
        F.format_string("%05d", F.col("id") % 5000).alias("ProductCode"),
    )
    [(name, codes)] = blocks.find_cuts(rows, hot_rows=5000, block_rows=2000)
    assert name == "hot" and 8 <= len(codes) <= 12


def test_block_numbers_match_the_ordered_cuts(spark):
    codes = sorted({f"{i * 7919 % 1000}" for i in range(60)} | {"é"}, key=str.encode)
    cuts = (("a", tuple(codes)), ("b", ("5",)), ("é", tuple(codes[:2])))
    rows = [(c, f"{i}") for c in ("a", "b", "c", "é") for i in range(0, 1000, 3)] + [("a", "é"), ("a", ""), ("c", "é")]
    numbered = blocks.with_block(pairs(spark, rows), cuts).collect()
    assert len(numbered) == len(rows)
    assert all(r[blocks.BLOCK] == blocks.block_of(r["CustomerID"], r["ProductCode"], cuts) for r in numbered)
    assert {r[blocks.BLOCK] for r in numbered if r["CustomerID"] == "c"} == {blocks.WHOLE}


@pytest.fixture
def skewed(spark):
    """3,000 products of one customer among 6,000 single-product customers."""
    hot = spark.range(3000).select(F.lit("hot").alias("CustomerID"), F.format_string("A%05d", "id").alias("ProductCode"))
    cold = spark.range(6000).select(F.col("id").cast("string").alias("CustomerID"), F.lit("A00000").alias("ProductCode"))
    return hot.union(cold).select(
        "CustomerID",
        "ProductCode",
        F.lit(Decimal("10.00")).cast(schemas.MONEY).alias("TransAmount"),
        F.lit(dt.datetime(2023, 1, 15)).cast("timestamp_ntz").alias("TransDate"),
        F.when(F.xxhash64("ProductCode") % 3 == 0, "D").otherwise("C").alias("TransType"),
    )


def test_one_customer_with_a_third_of_all_rows_is_spread(spark, monkeypatch, skewed):
    monkeypatch.setattr(blocks.find_cuts, "__defaults__", (None, 1000, 100, blocks.MAX_CUTS))
    found = blocks.with_cuts(skewed, SeriesOptions(positive_months=1))
    assert [(name, len(codes)) for name, codes in found.cuts] == [("hot", 29)]
    cut = series.running_balance(flows.monthly_flows(skewed, found), found)
    sizes = cut.groupBy("CustomerID", blocks.BLOCK).count()
    assert sizes.agg(F.max("count")).first()[0] <= 110
    assert sizes.where(f"CustomerID <> 'hot' AND {blocks.BLOCK} <> {blocks.WHOLE}").isEmpty()
    whole = series.running_balance(flows.monthly_flows(skewed))
    assert cut.select(whole.columns).exceptAll(whole).isEmpty()
    assert cut.count() == whole.count() == 9000
    kept = series.eligible_series(cut, found)
    expected = series.eligible_series(whole, SeriesOptions(positive_months=1))
    assert kept.select(expected.columns).exceptAll(expected).isEmpty()
    assert kept.count() == expected.count()


def test_features_follow_the_blocks(spark, monkeypatch, skewed):
    cuts = (("hot", ("A00010", "A02000")),)
    options = SeriesOptions(positive_months=1, cuts=cuts)
    table = spark.createDataFrame([("hot", 1), ("hot", 2), ("0", 3), ("none", 4)], "CustomerID string, Age int")
    cut = features.attach_features(series.labelled_series(skewed, options, keep_blocks=True), table, cuts)
    plain = SeriesOptions(positive_months=1, cuts=())
    whole = features.attach_features(series.labelled_series(skewed, plain), table)
    assert cut.columns == whole.columns and cut.count() == whole.count() > 3000
    assert cut.exceptAll(whole).isEmpty()
