"""Forests on counted rows: where features are categories, rows of equal vector, label and fold are one cell with
a count, and the count is all that a forest needs to know of them. A row's bootstrap weight is Poisson(rate), so a
cell of n rows has Poisson(n * rate): the same forest in distribution as on the rows, at a cost that no longer grows
with them. Bins, gain, limits, merging of leaves with one prediction, and votes are those of Spark's classifier."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm.env import ship

#: Distinct pairs of vector and label, by a sketch, and numbers in a level's histogram beyond which rows are not counted.
KINDS, NUMBERS = 4096, 2**22
SUBSETS = {"auto": lambda n, trees: n if trees == 1 else math.ceil(math.sqrt(n)), "all": lambda n, _: n, "sqrt": lambda n, _: math.ceil(math.sqrt(n)), "log2": lambda n, _: max(1, math.ceil(math.log2(n))), "onethird": lambda n, _: math.ceil(n / 3)}


@dataclass(frozen=True)
class Counted:
    """Of each distinct vector its bins by feature; counts by level, fold, vector and class."""

    bins: np.ndarray
    counts: np.ndarray


def known(model) -> bool:
    """Whether the forest is one that confusions() grows: nothing set but what it goes by."""
    return type(model) is RandomForestClassifier and model.getImpurity() == "gini" and model.getFeatureSubsetStrategy() in SUBSETS and model.getMinWeightFractionPerNode() == 0 and not any(model.isSet(p) for p in (model.weightCol, model.thresholds, model.leafCol))


def counted(df: DataFrame, model, level: str, levels: int, fold: str, folds: int) -> Counted | None:
    """The counts of all rows, in one pass after one that sketches how many distinct vectors and labels there are. None
    where they are too many, where a feature has more values than bins or is nominal, where a label or value is not what
    a forest takes, or where a fold holds all rows of a level: there Spark's own forest goes over the rows, or says what is wrong."""
    nominal = df.schema[model.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal")
    rows = df.select(vector_to_array(model.getFeaturesCol()).alias("x"), F.col(model.getLabelCol()).cast("double").alias("y"), F.col(level).cast("int").alias("level"), F.col(fold).cast("int").alias("fold"))
    if nominal or rows.agg(F.approx_count_distinct(F.xxhash64("x", "y"))).first()[0] > KINDS:
        return None
    few = rows.groupBy("x", "y", "level", "fold").agg(F.count("*").alias("n")).toArrow()  # bounded by KINDS, levels and folds
    x, y = few["x"].combine_chunks(), few["y"].to_numpy()
    wide = set(x.value_lengths().to_pylist())
    if len(wide) != 1 or None in wide or 0 in wide or x.flatten().null_count or not (np.isfinite(y) & (y >= 0) & (y == np.floor(y)) & (y < 100)).all():
        return None
    x = x.flatten().to_numpy().reshape(len(y), -1)
    if not np.isfinite(x).all():
        return None
    kinds, at = np.unique(x, axis=0, return_inverse=True)
    found = [np.unique(c, return_inverse=True) for c in kinds.T]
    most, classes = max(len(v) for v, _ in found), int(y.max()) + 1
    if most > model.getMaxBins() or kinds.size * most * classes > NUMBERS:
        return None
    counts = np.zeros((levels, folds, len(kinds), classes))
    np.add.at(counts, (few["level"].to_numpy(), few["fold"].to_numpy(), at.ravel(), y.astype(int)), few["n"].to_numpy())
    held = counts.cumsum(0).sum((2, 3))
    if (held.sum(1, keepdims=True) == held).any():
        return None
    return Counted(np.stack([i.ravel() for _, i in found], 1), counts)


def gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    out = np.ones(total.shape)
    for c in range(counts.shape[-1]):
        p = counts[..., c] / np.maximum(total, 1)
        out -= p * p
    return np.where(total > 0, out, 0.0)


def tree_votes(bins: np.ndarray, w: np.ndarray, depth: int, least: int, gain: float, subset: int, rng: np.random.Generator) -> np.ndarray:
    """Class shares, by vector, of a tree grown on the weights w of vector and class."""
    (n, width), classes, most = bins.shape, w.shape[1], int(bins.max()) + 1
    slots = np.arange(width) * most + bins
    at, stats, levels = np.zeros(n, dtype=np.int64), w.sum(0, keepdims=True), []
    while True:
        nodes, child = len(stats), np.full(len(stats), -1)
        levels.append((at, stats, child))
        if len(levels) > depth or most == 1:
            break
        live = np.flatnonzero(at >= 0)
        keys = (at[live, None] * (width * most) + slots[live]).ravel()
        sums = np.stack([np.bincount(keys, np.repeat(w[live, c], width), nodes * width * most) for c in range(classes)], -1).reshape(nodes, width, most, classes)
        left = sums.cumsum(2)[:, :, :-1]
        right = stats[:, None, None] - left
        n_left, n_right, total = left.sum(-1), right.sum(-1), np.maximum(stats.sum(-1), 1)[:, None, None]
        gains = gini(stats, stats.sum(-1))[:, None, None] - n_left / total * gini(left, n_left) - n_right / total * gini(right, n_right)
        ok = (n_left >= least) & (n_right >= least) & (gains >= gain)
        if subset < width:
            ok &= (rng.random((nodes, width)).argsort(1).argsort(1) < subset)[:, :, None]
        gains = np.where(ok, gains, -1.0).reshape(nodes, -1)
        best = gains.argmax(1)
        split = np.flatnonzero(gains[np.arange(nodes), best] > 0)
        if not len(split):
            break
        feature, cut = np.divmod(best[split], most - 1)
        child[split] = 2 * np.arange(len(split))
        stats = np.stack([left[split, feature, cut], right[split, feature, cut]], 1).reshape(-1, classes)
        went = live[child[at[live]] >= 0]
        to, at = child[at[went]], np.full(n, -1)
        at[went] = to + (bins[went, feature[to // 2]] > cut[to // 2])
    # leaves of one prediction are merged into their parent, from below
    leaf, said, ends = None, None, []
    for _, stats, child in reversed(levels):
        own, down = child < 0, np.maximum(child, 0)
        if leaf is not None:
            own |= leaf[down] & leaf[down + 1] & (said[down] == said[down + 1])
        leaf, said = own, stats.argmax(1)
        ends.append(own)
    out, open_ = np.zeros(w.shape), np.ones(n, dtype=bool)
    for (at, stats, _), own in zip(levels, reversed(ends), strict=True):
        here = open_ & (at >= 0) & own[at]
        out[here] = (stats / np.maximum(stats.sum(1, keepdims=True), 1))[at[here]]
        open_ &= ~here
    return out


def forest_votes(bins: np.ndarray, counts: np.ndarray, trees: int, depth: int, least: int, gain: float, rate: float, bootstrap: bool, subset: str, seed: list[int]) -> np.ndarray:
    """Votes by vector and class of a forest on counts of vector and class; tree i draws from a generator of (seed, i)."""
    out = np.zeros(counts.shape)
    for i in range(trees):
        rng = np.random.default_rng([*seed, i])
        w = rng.poisson(counts * rate) if bootstrap else counts if rate == 1 else rng.binomial(counts.astype(np.int64), rate)
        out += tree_votes(bins, w.astype(float), depth, least, gain, SUBSETS[subset](bins.shape[1], trees), rng)
    return out


def confusions(spark: SparkSession, rows: Counted, level: int, models: list) -> list[list[list[tuple[float, float, float]]]]:
    """By model and fold: (label, prediction, rows) of the fold under the model fitted on the other folds, of the rows up to a level. A forest is a row that Spark deals out."""
    ship(spark)
    bins, counts = rows.bins, rows.counts[:level + 1].sum(0)
    folds = len(counts)
    setting = [(m.getNumTrees(), m.getMaxDepth(), m.getMinInstancesPerNode(), m.getMinInfoGain(), m.getSubsamplingRate(), m.getBootstrap(), m.getFeatureSubsetStrategy(), m.getSeed() % 2**63) for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, f in zip(b["model"].to_pylist(), b["fold"].to_pylist(), strict=True):
                *given, seed = setting[i]
                test = counts[f]
                said = forest_votes(bins, counts.sum(0) - test, *given, [seed, f]).argmax(1)
                both = np.zeros((test.shape[1],) * 2)
                np.add.at(both, said, test)
                p, y = np.nonzero(both)
                yield pa.RecordBatch.from_pydict({"model": np.full(len(p), i), "fold": np.full(len(p), f), "label": y.astype(float), "prediction": p.astype(float), "n": both[p, y]})

    tasks = sorted(((i, f) for i in range(len(models)) for f in range(folds)), key=lambda t: -setting[t[0]][0] * setting[t[0]][1])
    dealt = spark.createDataFrame(tasks, "model int, fold int").repartition(len(tasks))
    out = [[[] for _ in range(folds)] for _ in models]
    for r in dealt.mapInArrow(run, "model long, fold long, label double, prediction double, n double").collect():  # a few rows a forest
        out[r.model][r.fold].append((r.label, r.prediction, r.n))
    return out
