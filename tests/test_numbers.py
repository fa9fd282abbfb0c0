"""Quantiles, scaling, splits, metrics and overrides."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline import schemas
from ebbline.functions.cells import filled
from ebbline.operators import metrics, overrides, quantiles, split
from ebbline.operators.scaling import RobustScale
from ebbline.options import SplitOptions
from ebbline.session import stage

PROBABILITIES = (0.25, 0.5, 0.75)


def columns_of(n, seed=0):
    rng = random.Random(seed)
    odd = [None, float("nan"), float("inf"), -float("inf")]
    return {
        "even": [rng.gauss(0, 100) for _ in range(n)],
        "skewed": [rng.expovariate(1) ** 6 for _ in range(n)],
        "tied": [float(rng.choice([0, 0, 0, 0, 1, 2])) for _ in range(n)],
        "constant": [5.0] * n,
        "holes": [rng.choice(odd) if rng.random() < 0.4 else rng.random() for _ in range(n)],
        "empty": [rng.choice(odd) for _ in range(n)],
    }


@pytest.mark.parametrize("counted_rows", [quantiles.COUNTED_ROWS, 0, 50])
@pytest.mark.parametrize("n", [1, 2, 3, 10, 201, 30000])
def test_quantiles_are_exact(spark, monkeypatch, n, counted_rows):
    """With small bounds all passes are taken."""
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", counted_rows)
    data = columns_of(n, seed=n)
    df = spark.createDataFrame(list(zip(*data.values())), ", ".join(f"{c} double" for c in data)).repartition(5)
    found = quantiles.exact_quantiles(df, list(data), PROBABILITIES)
    for column, values in data.items():
        kept = [v for v in values if v is not None and math.isfinite(v)]
        for p in PROBABILITIES:
            if kept:
                assert found[column, p] == pytest.approx(np.percentile(kept, p * 100), rel=1e-12, abs=1e-12)
            else:
                assert found[column, p] is None


def passes(monkeypatch, df, columns, values=PROBABILITIES):
    """Exact quantiles, the number of passes taken and the most rows that one of them gave the driver."""
    seen, count = [], quantiles._count

    def counted(*args):
        parts = count(*args)
        seen.append(sum(map(len, parts.values())))
        return parts

    monkeypatch.setattr(quantiles, "_count", counted)
    found = quantiles.exact_quantiles(df, columns, values)
    return found, len(seen), max(seen)


def test_all_columns_share_a_fixed_number_of_passes(spark, monkeypatch):
    cells = [f"CAST(xxhash64(id, {i}) AS DOUBLE) * pow(2D, {40 * i - 300}) AS x{i}" for i in range(18)]
    df = stage(spark.range(60_000).selectExpr(*cells), "doubles")
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", 0)
    names = [f"x{i}" for i in range(18)]
    found, count, rows = passes(monkeypatch, df, names)
    assert count == len(quantiles.SHIFTS) == 5
    assert rows <= 18 * 6 * 8192
    values = df.toPandas()
    for name in names:
        for p in PROBABILITIES:
            assert found[name, p] == pytest.approx(np.percentile(values[name], p * 100), rel=1e-14)


def test_few_rows_take_two_passes(spark, monkeypatch):
    df = spark.range(1000).selectExpr("CAST(7 AS DOUBLE) AS x", "CAST(id * id AS DOUBLE) AS y")
    found, count, _ = passes(monkeypatch, df, ["x", "y"])
    assert found["x", 0.25] == 7.0 and found["y", 0.5] == (499**2 + 500**2) / 2 and count == 2


def test_counting_makes_no_rows_of_cells(spark, monkeypatch):
    """A pass reads a row as it is, however many columns and parts are counted; parts do not depend on the batches."""
    cells = [f"CAST(xxhash64(id, {i}) AS DOUBLE) AS x{i}" for i in range(4)]
    df = stage(spark.range(0, 3000, 1, 3).selectExpr(*cells), "cells")
    plans, agg = [], type(df.groupBy()).agg

    def seen(self, *columns):
        found = agg(self, *columns)
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
        return found

    monkeypatch.setattr(type(df.groupBy()), "agg", seen)
    whole = quantiles.exact_quantiles(df, df.columns, PROBABILITIES)
    assert plans and not any("Generate" in plan for plan in plans)
    monkeypatch.setattr(quantiles, "BATCH_ROWS", 1)
    assert quantiles.exact_quantiles(df, df.columns, PROBABILITIES) == whole


def test_codes_keep_the_order_of_doubles(spark):
    rng = random.Random(4)
    tiny, most = 5e-324, 1.7976931348623157e308
    values = {0.0, tiny, -tiny, 3 * tiny, 2.0**-1022, 2.0**-1022 - tiny, 2.0**-1023, most, -most, 1.0, -1.0}
    for e in range(-1074, 1024, 3):
        power = math.ldexp(1.0, e)
        values |= {power, math.nextafter(power, 0), math.nextafter(power, math.inf), -power * (1 + rng.random() / 2)}
    values |= {struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)}
    values = sorted(v for v in values if math.isfinite(v))
    rows = quantiles._with_code(spark.createDataFrame([(v,) for v in values], "value double")).collect()
    bits = lambda v: struct.unpack("<q", struct.pack("<d", abs(v)))[0]
    for row in rows:
        assert row["code"] == (-bits(row["value"]) if row["value"] < 0 else bits(row["value"]))
        assert quantiles._value(row["code"]) == row["value"]
    assert quantiles._with_code(spark.createDataFrame([(-0.0,)], "value double")).first()["code"] == 0


def test_scaling(spark):
    df = spark.createDataFrame([("a", float(i), 5.0, None if i else 1.0) for i in range(10)], "k string, x double, c double, m double")
    scale = RobustScale.fit(df, ["x", "c", "m"])
    assert scale.stats == (("x", 4.5, 4.5), ("c", 5.0, 0.0), ("m", 1.0, 0.0))
    rows = scale.transform(df).orderBy("x").collect()
    assert [r["x"] for r in rows] == pytest.approx([(i - 4.5) / 4.5 for i in range(10)])
    assert {r["c"] for r in rows} == {0.0}
    assert sorted(r["m"] for r in rows) == [-1.0] * 9 + [0.0]
    assert scale.transform(df, sentinel=None).where("m IS NULL").count() == 9
    back = RobustScale.from_table(scale.to_table(spark), ["x", "c", "m"])
    assert back == scale


def test_scaling_undone_gives_the_input(spark):
    values = columns_of(500)["even"]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    scale = RobustScale.fit(df, ["x"])
    (_, median, iqr) = scale.stats[0]
    found = [r["x"] * iqr + median for r in scale.transform(df).collect()]
    assert sorted(found) == pytest.approx(sorted(values))


@pytest.mark.parametrize("spread", ["id % 2 * 1e9", "CASE WHEN id < 499 THEN -1e300 WHEN id > 500 THEN 1e300 ELSE id END", "id * id"])
def test_far_and_tied_values(spark, monkeypatch, spread):
    monkeypatch.setattr(quantiles, "COUNTED_ROWS", 2)
    df = spark.range(1000).selectExpr(f"CAST({spread} AS DOUBLE) AS x")
    values = sorted(r[0] for r in df.collect())
    found = quantiles.exact_quantiles(df, ["x"], (0.0, 0.25, 0.5, 0.9, 1.0))
    for p in (0.0, 0.25, 0.5, 0.9, 1.0):
        rank = p * 999
        low, high = values[math.floor(rank)], values[math.ceil(rank)]
        share = rank - math.floor(rank)
        assert found["x", p] == low * (1 - share) + high * share


def test_sentinel(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (-float("inf"),), (2.0,)], "x double")
    assert [r[0] for r in df.selectExpr(filled("x")).collect()] == [-1, -1, -1, -1, 2]


@pytest.fixture
def keyed(spark):
    rows = spark.range(20000).select(
        F.col("id").cast("string").alias("CustomerID"),
        F.lit("A").alias("ProductCode"),
        F.lit("2023-01-31").cast("date").alias("Date"),
        (F.xxhash64("id") % 20 == 0).cast("int").alias(schemas.TARGET),
    )
    return rows


def test_hash_split_keeps_label_shares(keyed):
    counts = {(r["split"], r[schemas.TARGET]): r["rows"] for r in split.split_counts(split.assign_split(keyed)).collect()}
    for label in (0, 1):
        share = counts["test", label] / (counts["test", label] + counts["train", label])
        assert abs(share - 0.2) < 0.03


def test_stratified_split_is_exact(keyed):
    counts = {
        (r["split"], r[schemas.TARGET]): r["rows"]
        for r in split.split_counts(split.assign_stratified_split(keyed)).collect()
    }
    total = {label: counts["test", label] + counts["train", label] for label in (0, 1)}
    assert counts["test", 0] + counts["test", 1] == 4000
    for label in (0, 1):
        assert abs(counts["test", label] - total[label] * 0.2) < 1


def test_stratified_split_does_not_depend_on_partitioning(keyed):
    def test_ids(df):
        return sorted(r[0] for r in split.assign_stratified_split(df).where("split = 'test'").select("CustomerID").collect())

    assert test_ids(keyed) == test_ids(keyed.repartition(13))


@pytest.mark.parametrize("counted", [1, 4096])
def test_rows_of_one_key_stay_together(keyed, monkeypatch, counted):
    """Copies are never parted; a label's share is met to within the copies of one key."""
    monkeypatch.setattr(split, "COUNTED_HASHES", counted)
    copies = keyed.limit(300).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(7))))
    marked = split.assign_stratified_split(copies)
    assert marked.columns == [*copies.columns, "split"]
    by_key = marked.groupBy("CustomerID").agg(F.countDistinct("split").alias("n"), F.count("*").alias("rows"))
    assert by_key.where("n > 1").isEmpty() and by_key.where("rows <> 7").isEmpty()
    for label in (0, 1):
        rows = marked.where(F.col(schemas.TARGET) == label)
        share = rows.count() * 0.2
        assert share - 1 < rows.where("split = 'test'").count() < share + 7
    text = marked.where("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Join" not in text


def test_too_many_labels_are_refused(keyed):
    with pytest.raises(ValueError, match="labels"):
        split.assign_stratified_split(keyed, "CustomerID")


def test_rare_labels_and_empty_input(spark, keyed):
    few = keyed.limit(3).withColumn(schemas.TARGET, F.col("CustomerID").cast("int"))
    assert split.assign_stratified_split(few).groupBy("split").count().count() == 2
    assert split.assign_stratified_split(keyed.limit(0)).isEmpty()


@pytest.mark.parametrize("counts, percent", [({0: 95, 1: 5}, 20), ({0: 7, 1: 7, 2: 7}, 20), ({0: 1}, 20), ({0: 3, 1: 2}, 50)])
def test_quota(counts, percent):
    quota = split.train_quota(counts, percent)
    total = sum(counts.values())
    assert sum(quota.values()) == total - math.ceil(total * percent / 100)
    assert all(0 <= quota[k] <= counts[k] and abs(quota[k] - counts[k] * sum(quota.values()) / total) < 1 for k in counts)


def test_folds_cover_every_row_once(keyed):
    folds = split.assign_fold(keyed, SplitOptions(folds=5)).groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    assert sum(r["count"] for r in folds) == 20000 and all(abs(r["count"] - 4000) < 300 for r in folds)


@pytest.mark.parametrize("counted", [1, 4096])
def test_stratified_folds_differ_by_one_row_at_most(keyed, monkeypatch, counted):
    monkeypatch.setattr(split, "COUNTED_HASHES", counted)
    rows = split.assign_stratified_split(keyed)
    folded = split.assign_stratified_fold(rows, rows="split = 'train'")
    assert folded.where("split = 'test' AND fold IS NOT NULL").isEmpty()
    train = folded.where("split = 'train'")
    by_label = {}
    for r in train.groupBy(schemas.TARGET, "fold").count().collect():
        by_label.setdefault(r[schemas.TARGET], {})[r["fold"]] = r["count"]
    whole = [sum(counts[f] for counts in by_label.values()) for f in range(5)]
    for counts in [*({f: n for f, n in c.items()} for c in by_label.values()), dict(enumerate(whole))]:
        assert sorted(counts) == [0, 1, 2, 3, 4] and max(counts.values()) - min(counts.values()) <= 1
    assert sum(whole) == 16000
    # Every row by itself, in the order of its hash.
    ranked = train.select(schemas.TARGET, "fold", split._digest("42-fold").alias("d")).toPandas()
    for _, own in ranked.groupby(schemas.TARGET):
        assert own.sort_values("d")["fold"].is_monotonic_increasing
    text = train._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "Join" not in text


def test_folds_of_rare_labels_copies_and_nothing(spark, keyed):
    few = keyed.limit(3).withColumn(schemas.TARGET, F.col("CustomerID").cast("int"))
    assert sorted(r["fold"] for r in split.assign_stratified_fold(few).collect()) == [0, 1, 2]
    none = keyed.limit(11).withColumn(schemas.TARGET, F.lit(None).cast("int"))
    assert sorted(r["count"] for r in split.assign_stratified_fold(none).groupBy("fold").count().collect()) == [2, 2, 2, 2, 3]
    copies = keyed.limit(40).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(6))))
    by_key = split.assign_stratified_fold(copies).groupBy("CustomerID").agg(F.countDistinct("fold").alias("n"))
    assert by_key.where("n <> 1").isEmpty()
    assert split.assign_stratified_fold(keyed.limit(0)).isEmpty()


@pytest.mark.parametrize("counts", [{0: 95, 1: 5}, {0: 7, 1: 7, 2: 7}, {0: 1}, {None: 4, 0: 3, 1: 0}])
def test_fold_quota(counts):
    quota = split.fold_quota(counts, 5)
    sizes = {k: [b - a for a, b in zip([0, *ends], [*ends, counts[k]])] for k, ends in quota.items()}
    assert all(max(own) - min(own) <= 1 and sum(own) == counts[k] for k, own in sizes.items())
    whole = [sum(own[f] for own in sizes.values()) for f in range(5)]
    assert max(whole) - min(whole) <= 1


@pytest.mark.parametrize(
    "pairs, accuracy, f1",
    [
        ([(1, 1), (1, 0), (0, 1), (0, 0), (0, 0)], 60.0, 0.5),
        ([(0, 0), (0, 0)], 100.0, 0.0),
        ([(1, 0), (0, 0)], 50.0, 0.0),
        ([(1, 1)], 100.0, 1.0),
    ],
)
def test_accuracy_and_f1(spark, pairs, accuracy, f1):
    df = spark.createDataFrame(pairs, "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert row["accuracy"] == pytest.approx(accuracy) and row["f1"] == pytest.approx(f1)
    counted = {(r["label"], r["prediction"]): r["rows"] for r in metrics.confusion_counts(df).collect()}
    assert counted.get((1, 1), 0) == row["tp"] and sum(counted.values()) == len(pairs)


def test_metrics_of_nothing(spark):
    row = metrics.classification_metrics(spark.createDataFrame([], "label int, prediction int")).first()
    assert row["accuracy"] is None and row["f1"] == 0


def test_auc_counts_ties_as_half(spark):
    rng = random.Random(1)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 6))) for _ in range(300)]
    positive = [s for y, s in rows if y]
    negative = [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    df = spark.createDataFrame(rows, "label int, score double")
    assert metrics.roc_auc(df, "score") == pytest.approx(wins / len(positive) / len(negative))


def test_overrides(spark):
    predictions = spark.createDataFrame(
        [("9813", "A", 0), ("9813", "B", 1), ("1", "A", 1), ("2", "A", 0)], "CustomerID string, ProductCode string, Struggle int"
    ).withColumn("Date", F.lit("2023-01-31").cast("date"))
    found = overrides.with_overrides(predictions, overrides.default_rules(spark))
    assert sorted((r[0], r[1], *r[3:]) for r in found.collect()) == [
        ("1", "A", 1, 0, 0), ("2", "A", 0, 0, 0), ("9813", "A", 1, 3, 152), ("9813", "B", 1, 3, 152),
    ]
    partial = spark.createDataFrame([("1", None, 2, None)], schemas.OVERRIDE_RULES)
    row = overrides.with_overrides(predictions, partial).where("CustomerID = '1'").first()
    assert tuple(row)[3:] == (1, 2, 0)
