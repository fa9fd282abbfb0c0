"""Boosting with columns drawn per tree and second-order leaves."""

import dataclasses
import math
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.options import ModelOptions
from ebbline.plans import boosting
from ebbline.session import stage

COLUMNS = [f"x{i}" for i in range(6)]
OPTIONS = ModelOptions(max_iter=4, columns_per_tree=True, subsampling_rate=1.0)


@pytest.fixture(scope="module")
def rows(spark):
    cells = [f"CAST(pmod(xxhash64(id, {i}), 1000) AS DOUBLE) / 1000 AS {c}" for i, c in enumerate(COLUMNS)]
    made = spark.range(600).selectExpr("id", *cells)
    label = "CAST(x0 + x1 * x2 + 0.3 * x5 > 0.9 AS INT) AS label"
    return stage(made.selectExpr(*COLUMNS, label, "CAST(id % 3 AS INT) AS fold"), "rows")


def test_a_tree_uses_its_drawn_columns_only(rows):
    model = boosting.boost(rows, COLUMNS, 3, dataclasses.replace(OPTIONS, max_iter=8, feature_fraction=0.5))
    for number, tree in enumerate(model.trees):
        assert tree.columns == boosting.drawn_columns(COLUMNS, dataclasses.replace(OPTIONS, feature_fraction=0.5), number)
        assert len(tree.columns) == 3 and set(re.findall(r"x\d", tree.leaf)) <= set(tree.columns)
    assert len({tree.columns for tree in model.trees}) > 1


def test_leaves_hold_gradient_over_curvature(rows):
    """Every leaf's value from the sums of its rows, worked out row by row."""
    model = boosting.boost(rows, COLUMNS, 2, OPTIONS)
    data = rows.select("*", *[F.expr(re.sub(r"leaf_(\d+)", r"\1", t.leaf)).alias(f"t{i}") for i, t in enumerate(model.trees)])
    margins = [0.0] * 600
    collected = data.collect()
    for i, tree in enumerate(model.trees):
        sums = {}
        for row, margin in zip(collected, margins):
            p = 1 / (1 + math.exp(-margin))
            g, h = sums.get(row[f"t{i}"], (0, 0))
            sums[row[f"t{i}"]] = g + row["label"] - p, h + p * (1 - p)
        for leaf, (g, h) in sums.items():
            assert tree.values[leaf] == pytest.approx(0.3 * g / (h + 1.0), rel=1e-9)
        margins = [m + tree.values[row[f"t{i}"]] for row, m in zip(collected, margins)]
    scored = [r[0] for r in rows.select(F.expr(model.margin())).collect()]
    assert scored == pytest.approx(margins)


def test_loss_falls_and_staging_changes_nothing(rows, monkeypatch):
    options = dataclasses.replace(OPTIONS, max_iter=6, subsampling_rate=0.8)
    whole = boosting.boost(rows, COLUMNS, 3, options)
    monkeypatch.setattr(boosting, "STAGED_TREES", 2)
    staged = boosting.boost(rows, COLUMNS, 3, options)
    assert [t.columns for t in staged.trees] == [t.columns for t in whole.trees]
    areas = []
    for model in (boosting.Boosted(whole.trees[:1]), whole, staged):
        areas.append(boosting.roc_auc(rows.select("label", F.expr(model.margin()).alias("score")), "score"))
    assert areas[1] > max(areas[0], 0.9) and areas[2] == pytest.approx(areas[1], abs=1e-6)


def test_the_model_is_a_stored_stage(rows, tmp_path):
    model = boosting.boost(rows, COLUMNS, 3, OPTIONS)
    pipeline = PipelineModel([model.stage()])
    pipeline.write().save(str(tmp_path / "m"))
    first = pipeline.transform(rows).select("rawPrediction", "probability", "prediction").collect()
    second = PipelineModel.load(str(tmp_path / "m")).transform(rows).select("rawPrediction", "probability", "prediction").collect()
    assert first == second
    assert all((r["probability"] > 0.5) == (r["prediction"] == 1) == (r["rawPrediction"] > 0) for r in first)
    plan = pipeline.transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan


def test_grid_search_takes_the_better_depth(rows):
    options = dataclasses.replace(OPTIONS, max_depths=(1, 3), max_iter=3, parallelism=4)
    means, best, depth = boosting.grid_search(rows, COLUMNS, options, 3)
    assert len(means) == 2 and all(0.5 < mean <= 1 for mean in means)
    assert depth == (1, 3)[means.index(max(means))] and len(best.trees) == 3


def test_one_label_and_constant_columns(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 1)] * 5, "a double, b double, label int")
    model = boosting.boost(rows, ["a", "b"], 2, dataclasses.replace(OPTIONS, max_iter=2))
    assert all(len(tree.values) == 1 and tree.values[0] > 0 for tree in model.trees)
    assert boosting.Boosted(()).margin() == "0D"


def test_a_grid_takes_as_many_passes_as_its_deepest_fit(rows, monkeypatch):
    """All folds and depths share a pass, and siblings one measurement."""
    measure, passes = boosting._measure, []

    def counted(here, steps, *rest):
        passes.append([step.nodes for step in steps])
        return measure(here, steps, *rest)

    monkeypatch.setattr(boosting, "_measure", counted)
    boosting.grid_search(rows, COLUMNS, ModelOptions(max_iter=3, max_depths=(1, 3), parallelism=4), 3)
    assert len(passes) <= 3 * 3 and all(len(nodes) == 2 * 3 + 2 and max(nodes) <= 2 for nodes in passes)


def test_a_pass_reads_blocks_and_equal_fits_once(rows, monkeypatch):
    """Rows are staged in blocks, and depths whose trees are equal share sums and margins; trees stay those of one fit."""
    measure, alike, widths = boosting._measure, [], set()

    def counted(here, steps, *rest):
        alike.append([step.like is not None for step in steps])
        widths.add((len(here.columns), here.count()))
        return measure(here, steps, *rest)

    monkeypatch.setattr(boosting, "_measure", counted)
    monkeypatch.setattr(boosting, "STAGED_TREES", 2)
    easy = rows.withColumn("x0", F.floor(F.col("x0") * 2).cast("double")).withColumn("label", F.col("x0").cast("int"))
    options = ModelOptions(max_iter=5, subsampling_rate=1.0, feature_fraction=1.0)
    fits = [boosting.Fit(depth, fold) for depth in (2, 3) for fold in (0, None)]
    together, scored = boosting.grow_all(easy, COLUMNS, fits, options, score=True)
    # One split is all there is to learn, so that the second depth never does anything else than the first.
    assert all(like == [False, False, True, True] for like in alike)
    assert all(blocks < 600 / 8 and columns <= 4 + 2 for columns, blocks in widths)
    assert together[:2] == together[2:] and scored.count() == 600 and scored.columns[:2] == ["label", "fold"]
    hard = ModelOptions(max_iter=5)
    together = boosting.grow_all(rows, COLUMNS, fits, hard)[0]
    for fit, model in zip(fits, together):
        alone = boosting.grow_all(rows, COLUMNS, [fit], hard)[0][0]
        for one, other in zip(model.trees, alone.trees):
            assert one.leaf == other.leaf and one.values == pytest.approx(other.values, rel=1e-9)


def test_default_trees_are_those_of_mllib(rows):
    """With all rows and columns and a bin a value, chances and predictions equal those of MLlib's booster."""
    coarse = rows.select(*[F.floor(F.col(c) * 20).cast("double").alias(c) for c in COLUMNS], "label", "fold")
    options = ModelOptions(max_iter=6, subsampling_rate=1.0, feature_fraction=1.0)
    found = boosting.boost(coarse, COLUMNS, 3, options).stage().transform(coarse)
    vectors = VectorAssembler(inputCols=COLUMNS, outputCol="vector").transform(found)
    learner = GBTClassifier(
        featuresCol="vector", labelCol="label", maxIter=6, stepSize=options.step_size, maxDepth=3, maxBins=256,
        predictionCol="predicted",
    )
    learner = learner.setRawPredictionCol("raw").setProbabilityCol("chances")
    both = learner.fit(vectors).transform(vectors).select("probability", vector_to_array("chances")[1], "prediction", "predicted")
    for chance, wanted, prediction, predicted in both.collect():
        assert chance == pytest.approx(wanted, rel=1e-9) and prediction == predicted


def test_rows_with_missing_values_are_refused(spark):
    for missing in [(float("nan"), 0), (1.0, None)]:
        rows = spark.createDataFrame([(1.0, 1), missing], "a double, label int")
        with pytest.raises(Exception, match="must not be null or NaN"):
            boosting.boost(rows, ["a"], 2, OPTIONS)


@pytest.mark.parametrize("depth, kind", [(1, np.uint8), (4, np.uint8), (10, np.uint16)])
def test_rows_find_their_leaves(depth, kind):
    """Numbers of up to 256 leaves take a byte, more of them four; every row is walked down by hand."""
    rng = np.random.default_rng(depth)
    bins = rng.integers(0, np.iinfo(kind).max + 1, (5, 400)).astype(kind)
    nodes = [1] if depth == 1 else [n for n in range(1, 2**depth) if rng.random() < 0.9 or n < 2 ** (depth - 1)]
    splits: dict[int, tuple[int, int]] = {}
    for node in nodes:
        if node == 1 or node // 2 in splits:
            splits[node] = int(rng.integers(5)), int(rng.integers(np.iinfo(kind).max))
    leaves = [n for n in {1, *(2 * n for n in splits), *(2 * n + 1 for n in splits)} if n not in splits]
    tree = boosting.Placed(splits, {n: i for i, n in enumerate(leaves)}, rng.random(len(leaves)))

    def leaf(row: np.ndarray) -> int:
        node = 1
        while node in splits:
            column, limit = splits[node]
            node = 2 * node + int(row[column] > limit)
        return tree.ends[node]

    assert tree.of_rows(bins).tolist() == [tree.values[leaf(row)] for row in bins.T]
    assert boosting.Placed({}, {1: 0}, np.array([3.0])).of_rows(bins).tolist() == [3.0] * 400


def test_sums_are_those_of_the_rows():
    """Rows of the other folds that the tree drew, by node, column and bin; trees since the margins were written count."""
    rng, n, sizes = np.random.default_rng(3), 500, [4, 7]
    bins = np.stack([rng.integers(0, size, n) for size in sizes]).astype(np.uint8)
    label, fold = rng.integers(0, 2, n).astype(float), rng.integers(-1, 3, n).astype(np.int32)
    block = boosting.Block(np.arange(n), fold, label, bins, [rng.normal(size=n), rng.normal(size=n)])
    since = boosting.Placed({1: (1, 3)}, {2: 0, 3: 1}, np.array([0.5, -0.25]))
    growing = boosting.Placed({1: (0, 1)}, {2: 0, 3: 1}, np.array([1, 0]))
    steps = [boosting.Step(held, 7, (since,), growing, 2, 1) for held in (0, None)]
    options = ModelOptions(subsampling_rate=0.5)
    for step, found in zip(steps, boosting._added(iter([block, block]), steps, sizes, options)):
        wanted, drawn = np.zeros((2, sum(sizes), 2)), boosting._sampled(block.row, options, 7)
        for i in range(n):
            if drawn[i] and fold[i] != step.held:
                margin = block.stored[1][i] + (0.5 if bins[1, i] <= 3 else -0.25)
                sign, node = 2 * label[i] - 1, 1 if bins[0, i] <= 1 else 0
                for place in (bins[0, i], sizes[0] + bins[1, i]):
                    wanted[node, place] += 2, 2 * 4 * sign / (1 + math.exp(2 * sign * margin))
        assert found == pytest.approx(wanted, rel=1e-9)


def test_python_gets_a_block_at_a_time(spark):
    before = spark.conf.get(boosting.BATCH)
    with pytest.raises(ZeroDivisionError), boosting._block_by_block(spark):
        sizes = spark.range(8).coalesce(1).mapInArrow(lambda batches: batches, "id long").mapInPandas(
            lambda frames: (frame.assign(id=len(frame)) for frame in frames), "id long"
        )
        assert {r["id"] for r in sizes.collect()} == {1}
        1 / 0
    assert spark.conf.get(boosting.BATCH) == before
