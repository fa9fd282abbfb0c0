"""Boosted-tree model: pipeline, grid search, storage."""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbline.functions.cells import filled
from ebbline.operators.scaling import RobustScale
from ebbline.options import ModelOptions, SplitOptions
from ebbline.schemas import MODEL_FEATURES, TARGET
from ebbline.plans import boosting
from ebbline.session import stage
from ebbline.sources import commits

VECTOR = "features"


@dataclass(frozen=True)
class FittedModel:
    """Scaling and trees as one pipeline, with the grid's mean AUC per depth."""

    pipeline: PipelineModel
    scale: RobustScale
    depth: int
    auc_by_depth: tuple[tuple[int, float], ...]


def prepare_stage(scale: RobustScale | None, features: Sequence[str] = MODEL_FEATURES) -> SQLTransformer:
    """Scaled features as new columns, missing and infinite values as -1, in one SQL stage.

    The fitted numbers sit in the stage itself, so that saving the pipeline saves them too.
    Without a scale the raw values are taken.
    """
    cells = scale.expressions() if scale else {f: filled(f"CAST({f} AS DOUBLE)") for f in features}
    columns = ", ".join(f"{cells[name]} AS x_{name}" for name in features)
    return SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__")


def assembler(features: Sequence[str] = MODEL_FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"x_{name}" for name in features], outputCol=VECTOR)


def fit_model(
    train: DataFrame, scale: RobustScale, options: ModelOptions, split: SplitOptions
) -> FittedModel:
    """Scale, search the grid and return the pipeline that scores raw rows.

    ``train`` has the fold column and is read several times; stage it first. A grid of one depth is
    fitted directly.
    """
    columns = [f"x_{name}" for name in MODEL_FEATURES]
    prepared = prepare_stage(None if options.reference_compat else scale).transform(train)
    rows = stage(prepared.select(*columns, F.col(TARGET).alias("label"), "fold"), "prepared")
    if len(options.max_depths) == 1:
        scores, depth = [], options.max_depths[0]
        best = boosting.boost(rows, columns, depth, options)
    else:
        scores, best, depth = boosting.grid_search(rows, columns, options, split.folds)
    return FittedModel(
        pipeline=PipelineModel(stages=[prepare_stage(scale), best.stage()]),
        scale=scale,
        depth=depth,
        auc_by_depth=tuple((depth, float(score)) for depth, score in zip(options.max_depths, scores)),
    )


@dataclass(frozen=True)
class StoredModel:
    """A model as read back: what scores, the statistics it scales by, and how it was trained."""

    pipeline: PipelineModel
    scale: RobustScale
    options: dict
    depth: int
    digest: str


def save_model(
    model: FittedModel, spark: SparkSession, path: str, options: ModelOptions = ModelOptions(), run: str | None = None
) -> str:
    """Commit pipeline, scaler statistics and options as one version of the model at ``path``; returns its digest.

    Until all of it is written, and if that fails, the version before stays the one that is loaded.
    """

    def write(folder: str) -> dict:
        model.pipeline.write().save(f"{folder}/pipeline")
        save_scale(model.scale, spark, folder)
        return {"digest": _digest(spark, folder), "depth": model.depth, "options": dataclasses.asdict(options)}

    return commits.publish(spark, path, write, run, keep=False).facts["digest"]


def load_model(spark: SparkSession, path: str, number: int | None = None) -> StoredModel:
    """A committed version of the model, by default the last.

    A version whose files are not all those it was committed with is refused.
    """
    found = commits.version(spark, path, number)
    [folder] = commits.folders(spark, path, number)
    if _digest(spark, folder) != found.facts["digest"]:
        raise ValueError(f"{path}: the files of version {found.number} are not those of its commit")
    return StoredModel(
        PipelineModel.load(f"{folder}/pipeline"),
        load_scale(spark, folder),
        found.facts["options"],
        found.facts["depth"],
        found.facts["digest"],
    )


def _digest(spark: SparkSession, folder: str) -> str:
    """Of the names and contents of all files below ``folder``, read where they are; a few dozen rows."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.substring_index("path", f"{folder.rsplit('/', 1)[-1]}/", -1)
    rows = files.select(name.alias("name"), F.sha2("content", 256).alias("digest")).collect()
    return hashlib.sha256("\n".join(sorted(f"{r['name']} {r['digest']}" for r in rows)).encode()).hexdigest()


def save_scale(scale: RobustScale, spark: SparkSession, folder: str) -> None:
    scale.to_table(spark).coalesce(1).write.parquet(f"{folder}/scaler")


def load_scale(spark: SparkSession, folder: str) -> RobustScale:
    return RobustScale.from_table(spark.read.parquet(f"{folder}/scaler"), MODEL_FEATURES)
