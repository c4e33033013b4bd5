"""Cross-validation over a grid that the caller states, whole or by successive halving."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.columns import hash_share

from .counted import confusions, counted, known

#: A grid for forests that one session can search.
FOREST_GRID = {"numTrees": [50, 150], "maxDepth": [5, 10], "minInstancesPerNode": [10, 20]}


def cross_validate(df: DataFrame, model, label: str, grid: dict[str, list] | None = None, folds: int = 5, metric: str = "f1", parallelism: int = 4, seed: int = 12345) -> CrossValidatorModel:
    """The best parameters by the mean metric of the folds; parameters the model lacks raise."""
    build = ParamGridBuilder()
    for name, values in (FOREST_GRID if grid is None else grid).items():
        build = build.addGrid(model.getParam(name), values)
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    return CrossValidator(estimator=model, estimatorParamMaps=build.build(), evaluator=evaluator, numFolds=folds, parallelism=parallelism, seed=seed).fit(df)


def best_params(found: CrossValidatorModel) -> dict[str, object]:
    """Parameters, by name, of the candidate with the best mean metric."""
    at = max(range(len(found.avgMetrics)), key=found.avgMetrics.__getitem__)
    return {p.name: v for p, v in found.getEstimatorParamMaps()[at].items()}


@dataclass(frozen=True)
class Score:
    rung: int
    params: dict[str, object]
    rows: int
    metric: float


@dataclass(frozen=True)
class Halving:
    best: dict[str, object]
    scores: list[Score]


def successive_halving(df: DataFrame, model, label: str, key: Column, grid: dict[str, list] | None = None, folds: int = 5, metric: str = "f1", rungs: int = 3, keep: float = 0.5, parallelism: int = 4) -> Halving:
    """The best parameters of a grid that would cost too much on all rows. Every candidate is
    cross-validated on the rows whose key hashes into the first 1 / 2^(rungs - 1) of all; after each
    rung the better share `keep` goes on (ties by the order of the grid) with twice the rows, and the
    last rung has all. Samples and folds go by hash, so they do not depend on partitioning
    and every sample holds the ones before it. Null keys are one key. Where the features are few categories,
    forests are grown on the counts of all rows (see counted) instead of passing over the rows for each level of each."""
    names = list(FOREST_GRID if grid is None else grid)
    for n in names:
        if not model.hasParam(n):
            raise ValueError(f"the model has no parameter {n!r}")
    alive = [dict(zip(names, values, strict=True)) for values in product(*(FOREST_GRID if grid is None else grid).values())]
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName=metric)
    share = hash_share(F.coalesce(key.cast("string"), F.lit("null")), 2**32)
    rows = df.withColumns({"_share": share, "_fold": F.floor(share / 2**8) % folds})
    tops = [2 ** (32 - (rungs - 1 - rung)) for rung in range(rungs)]
    made = lambda params: model.copy({model.getParam(k): v for k, v in params.items()})
    cells = None
    if metric != "logLoss" and all(known(made(p)) for p in alive):
        cells = counted(rows.withColumn("_rung", sum(((F.col("_share") >= t).cast("int") for t in tops[:-1]), F.lit(0))), model, "_rung", rungs, "_fold", folds)
    scores: list[Score] = []

    def advance(rung: int, n: int, found: list[float]) -> list[dict[str, object]]:
        scores.extend(Score(rung, p, n, m) for p, m in zip(alive, found, strict=True))
        order = sorted(range(len(alive)), key=lambda i: -found[i])
        return [alive[i] for i in order[:max(1, math.ceil(len(alive) * keep))]]

    for rung in range(rungs if cells else 0):
        weighted = evaluator.copy({evaluator.weightCol: "n"})
        few = f"`{label}` double, {evaluator.getPredictionCol()} double, n double"
        parts = [(i, one) for i, by_fold in enumerate(confusions(df.sparkSession, cells, rung, [made(p) for p in alive])) for one in by_fold]
        with ThreadPoolExecutor(parallelism) as pool:
            each = list(pool.map(lambda part: weighted.evaluate(df.sparkSession.createDataFrame(part[1], few).coalesce(1)), parts))
        alive = advance(rung, int(cells.counts[:rung + 1].sum()), [sum(m for (j, _), m in zip(parts, each, strict=True) if j == i) / folds for i in range(len(alive))])
    for rung in range(0 if cells else rungs):
        some = rows.filter(F.col("_share") < tops[rung]).drop("_share").persist()
        try:
            n = some.count()
            parts = [(some.filter(F.col("_fold") != f), some.filter(F.col("_fold") == f)) for f in range(folds)]

            def tried(params: dict[str, object]) -> float:
                fitted = made(params)
                return sum(evaluator.evaluate(fitted.fit(a).transform(b)) for a, b in parts) / folds  # noqa: B023

            with ThreadPoolExecutor(parallelism) as pool:
                found = list(pool.map(tried, alive))
        finally:
            some.unpersist()
        alive = advance(rung, n, found)
    return Halving(alive[0], scores)
